"""The default stop list."""

# The Hebrew stop words, letters, digits and marks that a row must
# not hold, and the empty word.
HEBREW_STOPWORDS = tuple(
    r"""
    ״ ׳ של רב פי עם עליו עליהם על עד מן מכל מי מהם מה מ למה לכל לי לו להיות לה לא כן כמה
    כלי כל כי יש ימים יותר יד י זה ז ועל ומי ולא וכן וכל והיא והוא ואם ו הרבה הנה היו היה היא הזה
    הוא דבר ד ג בני בכל בו בה בא את אשר אם אלה אל אך איש אין אחת אחר אחד אז אותו
    ־ ^ ? ; : 1 . - * " ! שלשה בעל פני גדול שם עלי עולם מקום לעולם לנו להם ישראל יודע זאת
    השמים הזאת הדברים הדבר הבית האמת דברי במקום בהם אמרו אינם אחרי אותם אדם חלק שני
    שכל שאר ש ר פעמים נעשה ן ממנו מלא מזה ם לפי ל כמו כבר כ זו ומה ולכל ובין ואין הן היתה
    הא ה בל בין בזה ב אף אי אותה או אבל א ~ @ # $ % & ( ) _ = + [ ] { } \ | / > < ' , `
    0 2 3 4 5 6 7 8 9
    """.split()
) + ("",)
