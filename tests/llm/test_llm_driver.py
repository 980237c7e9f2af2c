"""What the driver holds while a run of many steps goes on."""

from trigramma.llm import language_id
from trigramma.session import materialised, run_folder


def whole_collections(spark):
    """How often the driver's JVM has collected all of its garbage."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if not any(x in b.getName() for x in ("Young", "Scavenge", "Copy")))


def test_steps_of_a_run_are_let_go_of(spark):
    with run_folder(spark, "steps"):
        before = whole_collections(spark)
        materialised(spark.range(3), "step")
        inside = whole_collections(spark)
        assert inside > before
    assert whole_collections(spark) > inside


def test_the_driver_passes_the_field_on_packed(spark):
    rows = [(i, f"the white house {i}" if i % 2 else f"la maison blanche {i}", "en" if i % 2 else "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    packed, field = language_id.learn_packed(docs), language_id.learn(docs)
    assert len(packed) * 4 < field.grams.nbytes
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.label(docs, packed).collect()}
    assert {i: x for i, (x, _) in found.items()} == {i: lang for i, _, lang in rows}
    assert all(score > 0.5 for _, score in found.values())
    assert language_id.learn_packed(docs.where("doc_id < 0")) is None
    assert [tuple(r)[1:] for r in language_id.label(docs.limit(1), None).collect()] == [("und", 0.0)]
