"""Reading, parsing and writing."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from test_golden import EDGE_LINES, lines_of
from trigramma.functions.scalar import split_phrase
from trigramma.functions.stopwords import HEBREW_STOPWORDS
from trigramma.operators import filters
from trigramma.operators.ranking import predict
from trigramma.plans import model
from trigramma.plans.model import RunCounts, build_model, kept_ngrams, kept_rows, model_of, write_model_text
from trigramma.session import discard, materialised, scratch_path, shared_folder
from trigramma.sources import readers, writers


def words(df):
    return sorted(" ".join(r) for r in df.select("w1", "w2", "w3").collect())


@pytest.mark.parametrize("bad", ["a b c\t2000", "a b c\t2000\t12x", "", "a b c\t2000\t", "a b\t2000\t1x"])
def test_bad_count_fails_even_in_a_row_that_would_be_dropped(spark, bad):
    for text in (bad, bad.replace("a b", "A 1")):
        with pytest.raises(PySparkException, match="no numeric count"):
            kept_rows(lines_of(spark, ["d e f\t2000\t1", text]), [], "a-z").collect()


def test_bad_counts_dropped_or_kept_apart(spark):
    lines = lines_of(spark, ["a b c\t2000\t2", "a b c\t2000", "a b c\t2000\t12x", "", "d e f\t1\t3.5\t7"])
    assert sorted(map(tuple, readers.parse_ngrams(lines, "drop").collect())) == [("a b c", 2.0), ("d e f", 3.5)]
    apart = readers.parse_ngrams(lines, "quarantine")
    assert sorted(r.bad_record for r in apart.where("cnt is null").collect()) == ["", "a b c\t2000", "a b c\t2000\t12x"]
    assert words(kept_rows(lines, [], "a-z", "quarantine")) == ["a b c", "d e f"]
    with pytest.raises(ValueError):
        readers.parse_ngrams(lines, "ignore")


def test_alphabet_and_number_of_words(spark):
    ngrams = spark.createDataFrame(
        [("a b c",), ("a b",), ("a b c d",), ("a b c1",), ("a  b c",), (" a b c",), ("a b c ",), ("a b c\n",),
         ("A b c",), ("",), ("  ",), ("a b c d1",)], "ngram string")
    letters = {r.ngram for r in filters.filter_alphabet(ngrams, "a-z").collect()}
    assert letters == {"a b c", "a b", "a b c d", "a b c "}
    three = {r.ngram for r in filters.filter_arity(filters.filter_alphabet(ngrams, "a-z")).collect()}
    assert three == {"a b c", "a b c d", "a b c "}
    hebrew = spark.createDataFrame([("בוקר טוב היום",), ("! טוב )",), ("a b c",)], "ngram string")
    assert [r.ngram for r in filters.filter_alphabet(hebrew).collect()] == ["בוקר טוב היום"]


def test_alphabet_filter_takes_very_long_rows(spark):
    long = spark.range(1).select(F.expr("repeat('abc ', 500000)").alias("ngram"))
    assert filters.filter_alphabet(long, "a-z").count() == 1


@pytest.mark.parametrize("as_table", [True, False])
def test_stop_words_in_any_place(spark, as_table):
    rows = spark.createDataFrame(
        [("a", "b", "c", 1), ("x", "b", "c", 2), ("a", "x", "c", 3), ("a", "b", "x", 4), ("y", "y", "y", 5)],
        "w1 string, w2 string, w3 string, id int")
    words = ["x", "y", "x"]
    stop = spark.createDataFrame([(w,) for w in words], "word string") if as_table else words
    left = filters.filter_stopwords(rows, stop)
    assert left.columns == rows.columns and [r.id for r in left.collect()] == [1]
    assert filters.filter_stopwords(rows, []).count() == 5


def test_stop_word_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_bytes("של\r\n רב \r\nשל\r\n\r\n\r\n".encode())
    assert {r.word for r in readers.read_stopwords(spark, str(path)).collect()} == {"של", "רב", ""}
    assert len(HEBREW_STOPWORDS) == len(set(HEBREW_STOPWORDS)) == 181


def test_sequence_files_in_a_folder_and_by_glob(spark, tmp_path):
    folder = str(tmp_path / "seq")
    writers.write_ngram_seq(lines_of(spark, EDGE_LINES).repartition(3), folder)
    for path in (folder, folder + "/part-*"):
        assert sorted(r.value for r in readers.read_ngram_seq(spark, path).collect()) == sorted(EDGE_LINES)
    raw = spark.sparkContext.sequenceFile(folder, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    assert raw.count() == len(EDGE_LINES)
    model = build_model(readers.read_ngram_seq(spark, folder), ["the"], "a-z")
    assert model.count() == 7


def test_text_in_and_out(spark, tmp_path):
    source, out = tmp_path / "lines.txt", tmp_path / "out"
    source.write_text("\n".join(EDGE_LINES) + "\n")
    model = build_model(readers.read_ngram_text(spark, str(source)), ["the"], "a-z")
    writers.write_ranked_text(model, str(out))
    written = [line for part in sorted(out.glob("part-*")) for line in part.read_text().splitlines()]
    assert [line.split("\t")[0] for line in written] == [f"{r.w1} {r.w2} {r.w3}" for r in model.collect()]
    assert written[2] == "lone pair here\tNaN"
    assert float(written[0].split("\t")[1]) == pytest.approx(0.5988786746582795, abs=1e-12)
    writers.write_ranked_text(model, str(tmp_path / "one"), single_file=True)
    parts = list((tmp_path / "one").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text().splitlines() == written
    with pytest.raises(PySparkException):
        writers.write_ranked_text(model, str(out))


def test_stages_are_kept_under_their_names(spark, tmp_path):
    rows = kept_rows(lines_of(spark, EDGE_LINES), ["the"], "a-z")
    folder = str(tmp_path / "stages")
    staged = model_of(rows, "null", stage_dir=folder)
    assert set(map(tuple, staged.collect())) == set(map(tuple, model_of(rows, "null").collect()))
    assert readers.read_stage(spark, folder + "/trigram_sums").count() == 7
    assert readers.read_stage(spark, folder + "/trigram_statistics").count() == 7
    with pytest.raises(FileExistsError):
        model_of(rows, stage_dir=folder)


def test_trigrams_of_short_and_odd_texts(spark):
    texts = spark.createDataFrame(
        [(1, "a b c d"), (2, "a b"), (3, ""), (4, None), (5, " a  b\nc\t"), (6, "one")], "id int, text string")
    found = readers.trigrams_from_text(texts, "text", "id").collect()
    assert sorted((r.id, r.w1, r.w2, r.w3) for r in found) == [
        (1, "a", "b", "c"), (1, "b", "c", "d"), (5, "", "a", "b"), (5, "a", "b", "c"), (5, "b", "c", "")]


def test_one_long_text(spark):
    text = spark.range(1).select(F.expr("repeat('a b c d e ', 200000)").alias("text"))
    assert readers.trigrams_from_text(text).count() == 1_000_001 - 2


def test_phrases(spark):
    row = spark.createDataFrame([("a b c",)], "t string").select(*split_phrase(F.col("t"))).first()
    assert tuple(row) == ("a", "b", "c")


@pytest.mark.parametrize("on_bad", ["drop", "quarantine", "fail"])
def test_row_counts_come_with_the_run(spark, on_bad):
    bad = [] if on_bad == "fail" else ["red fox hides\t2000\tsix"]
    seen = RunCounts()
    model = build_model(lines_of(spark, EDGE_LINES + bad), ["the"], "a-z", order=None, on_bad=on_bad, seen=seen)
    assert seen.get() == {"lines": len(EDGE_LINES + bad), "bad lines": len(bad), "kept rows": 9, "trigrams": 7}
    assert model.count() == 7


def test_a_second_start_goes_on_from_finished_stages(spark, tmp_path):
    rows = kept_rows(lines_of(spark, EDGE_LINES), ["the"], "a-z")
    folder = str(tmp_path / "stages")
    first = model_of(rows, "null", stage_dir=folder, stage_key="edge lines").collect()
    before = sorted(p.name for p in (tmp_path / "stages" / "trigram_sums").iterdir())
    again = model_of(rows, "null", stage_dir=folder, stage_key="edge lines").collect()
    assert set(map(tuple, first)) == set(map(tuple, again))
    assert before == sorted(p.name for p in (tmp_path / "stages" / "trigram_sums").iterdir())
    with pytest.raises(ValueError):
        model_of(rows, stage_dir=folder, stage_key="other lines")


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert shared_folder(spark) == named
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_ieee_division(spark):
    from trigramma.functions.scalar import ieee_divide
    from trigramma.functions.sql import register_functions

    pairs = [(1.0, 2.0), (0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (math.nan, 0.0), (math.nan, 1.0), (0.0, 3.0)]
    wanted = [0.5, math.nan, math.inf, -math.inf, math.nan, math.nan, 0.0]
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, a double, b double")
    register_functions(spark)
    df.createOrReplaceTempView("pairs")
    for found in (df.select("i", ieee_divide(F.col("a"), F.col("b")).alias("q")),
                  spark.sql("SELECT i, ieee_divide(a, b) AS q FROM pairs")):
        values = [r.q for r in found.orderBy("i").collect()]
        assert [repr(v) for v in values] == [repr(w) for w in wanted]


def folders(path):
    return sorted(p.name for p in path.iterdir()) if path.exists() else []


def test_a_keyed_write_leaves_foreign_folders_alone(spark, tmp_path):
    """A stage without a key, one of another key, plain Parquet, an empty folder: all stay."""
    new = spark.range(3)
    places = {name: str(tmp_path / name) for name in ("keyless", "other", "plain", "empty")}
    writers.write_stage(spark.range(5), places["keyless"])
    writers.write_stage(spark.range(5), places["other"], "other")
    spark.range(5).write.parquet(places["plain"])
    (tmp_path / "empty").mkdir()
    for name, path in places.items():
        for key in (None, "mine"):
            with pytest.raises((ValueError, FileExistsError)):
                writers.write_stage(new, path, key)
        if name != "empty":
            assert readers.read_stage(spark, path).count() == 5
    assert folders(tmp_path) == sorted(places)


def test_a_broken_off_write_leaves_no_stage(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "stage")
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 90, F.raise_error("stop").cast("long")).otherwise(F.col("id")).alias("id"))
    for key in (None, "k"):
        with pytest.raises(PySparkException, match="stop"):
            writers.write_stage(bad, path, key)
        assert folders(tmp_path) == []
    # Killed between writing and renaming: what lies there is no stage, and the next start clears it.
    with monkeypatch.context() as patched:
        patched.setattr(writers, "_put", lambda *args: (_ for _ in ()).throw(SystemExit))
        patched.setattr(writers, "clear", lambda *args: None)
        with pytest.raises(SystemExit):
            writers.write_stage(spark.range(7), path, "k")
    assert len(folders(tmp_path)) == 1 and folders(tmp_path)[0].startswith("stage.unfinished-")
    with pytest.raises(PySparkException):
        readers.read_stage(spark, path).count()
    assert writers.write_stage(spark.range(9), path, "k").count() == 9
    assert folders(tmp_path) == ["stage"]
    assert writers.write_stage(bad, path, "k").count() == 9


def test_an_empty_stage_is_a_stage(spark, tmp_path):
    path = str(tmp_path / "stage")
    for _ in range(2):
        found = writers.write_stage(spark.range(5).where("id > 9"), path, "none")
        assert found.count() == 0 and found.columns == ["id"]


def test_counts_survive_a_restart(spark, tmp_path):
    lines = lines_of(spark, EDGE_LINES + ["red fox hides\t2000\tsix"])
    wanted = {"lines": len(EDGE_LINES) + 1, "bad lines": 1, "kept rows": 9, "trigrams": 7}
    for folder in (None, str(tmp_path / "stages")):
        for _ in range(2):
            seen = RunCounts()
            build_model(lines, ["the"], "a-z", None, "drop", stage_dir=folder, stage_key=folder and "edge", seen=seen)
            assert seen.get() == wanted
    # A stage that was written without counting cannot tell.
    plain = str(tmp_path / "plain")
    build_model(lines, ["the"], "a-z", None, "drop", stage_dir=plain, stage_key="edge")
    with pytest.raises(ValueError, match="without counting"):
        build_model(lines, ["the"], "a-z", None, "drop", stage_dir=plain, stage_key="edge", seen=RunCounts())


def read_files(df):
    """Rows out of the scan, and files in it, by the metrics of the run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    seen = [leaves.apply(i) for i in range(leaves.size())]
    scans = [leaf for leaf in seen if "Scan" in leaf.nodeName()]
    value = lambda scan, name: int(scan.metrics().apply(name).value())
    return sum(value(s, "numFiles") for s in scans), sum(value(s, "numOutputRows") for s in scans)


def test_a_lookup_reads_the_zones_of_its_keys(spark, tmp_path, conf):
    conf(adaptive__coalescePartitions__enabled="false", shuffle__partitions="16")
    model = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('a', lpad(id % 500, 4, '0'))) AS w1", "concat('b', id % 7) AS w2", "concat('c', id) AS w3", "id / 20000 AS p")
    path = str(tmp_path / "model")
    writers.write_stage(model, path, "zones", by=["w1", "w2"])
    assert set(map(tuple, readers.read_stage(spark, path).drop("zone").collect())) == set(map(tuple, model.collect()))
    asked = spark.createDataFrame([("a0007", "b3"), ("a0008", "b1"), ("a0007", "b3"), ("none", "b1"), (None, "b1")], "w1 string, w2 string")
    part = readers.read_zones(spark, path, asked)
    assert part.columns == model.columns
    files, rows = read_files(part)
    assert 1 <= files <= 3 and rows < 5_000
    whole = set(map(tuple, predict(model, asked, 3).collect()))
    assert len(whole) == 6 and set(map(tuple, predict(part, asked, 3).collect())) == whole
    # A hot pair lies in several zones, all of which are read.
    hot = spark.createDataFrame([("hot", "b1")], "w1 string, w2 string")
    files, _ = read_files(readers.read_zones(spark, path, hot))
    assert files >= 2
    assert set(map(tuple, predict(readers.read_zones(spark, path, hot), hot, 3).collect())) == set(map(tuple, predict(model, hot, 3).collect()))
    assert readers.read_zones(spark, path, asked.limit(0)).count() == 0
    # A stage without zones is read whole.
    plain = str(tmp_path / "plain")
    writers.write_stage(model, plain)
    assert readers.read_zones(spark, plain, asked).count() == 20_000


def test_sequence_files_are_converted_once(spark, tmp_path):
    source, stage = str(tmp_path / "seq"), str(tmp_path / "parsed")
    writers.write_ngram_seq(lines_of(spark, EDGE_LINES), source)
    first = readers.convert_ngram_seq(spark, source, stage, "edge")
    again = readers.convert_ngram_seq(spark, source, stage, "edge")
    assert first.columns == ["ngram", "cnt"] and first.count() == again.count() == len(EDGE_LINES)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Python" not in plan and "ExistingRDD" not in plan
    assert model_of(kept_ngrams(again, ["the"], "a-z")).count() == 7


def test_a_run_clears_its_tables(spark, tmp_path):
    from urllib.parse import urlparse

    shared = urlparse(shared_folder(spark)).path
    before = sorted(os.listdir(shared))
    write_model_text(lines_of(spark, EDGE_LINES), str(tmp_path / "out"), ["the"], "a-z")
    assert sorted(os.listdir(shared)) == before
    with pytest.raises(PySparkException):
        write_model_text(lines_of(spark, ["a b c\t1\tx"]), str(tmp_path / "bad"), ["the"], "a-z")
    assert sorted(os.listdir(shared)) == before
    table = materialised(spark.range(3), "three")
    assert len(os.listdir(shared)) == len(before) + 1
    discard(table)
    assert sorted(os.listdir(shared)) == before


def test_small_scans_are_dealt_out_and_large_ones_left(spark, conf, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 1).write.parquet(path)
    assert "RoundRobinPartitioning(8)" in readers.spread(spark.read.parquet(path))._jdf.queryExecution().toString()
    conf(files__maxPartitionBytes="100b")
    assert "RoundRobin" not in readers.spread(spark.read.parquet(path))._jdf.queryExecution().toString()


def test_dealt_rows_go_to_more_tasks_the_larger_the_table(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 100_000, 1, 1).selectExpr("id", "concat('text ', id) AS text").write.parquet(path)
    held = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.startswith("part-"))
    monkeypatch.setattr(readers, "DEALT", held // 20)
    dealt = readers.spread(spark.read.parquet(path).select("text"))
    assert "RoundRobinPartitioning(24)" in dealt._jdf.queryExecution().toString()
    assert dealt.count() == 100_000


def test_files_that_keep_the_cores_busy_are_left_as_they_lie(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1600, 1, 16).write.parquet(path)
    assert "RoundRobin" not in readers.spread(spark.read.parquet(path))._jdf.queryExecution().toString()
    path = str(tmp_path / "few")
    spark.range(0, 1600, 1, 7).write.parquet(path)
    assert "RoundRobinPartitioning(8)" in readers.spread(spark.read.parquet(path))._jdf.queryExecution().toString()


@pytest.mark.parametrize("stop", [["the", None], []])
def test_words_are_looked_at_once_with_the_same_trigrams(spark, stop):
    texts = spark.createDataFrame(
        [(1, "a b  c\td\x0be the f g h"), (2, " a b c"), (3, "a b c "), (4, "A b c d1 e f g"), (5, None), (6, ""), (7, "a b"),
         (8, "a b\u00a0c d e f"), (9, "the the the a b c")], "id long, text string")
    plain = filters.filter_stopwords(filters.filter_alphabet(readers.trigrams_from_text(texts), "a-z"), stop)
    found = model.kept_text_rows(texts, stop, "a-z")
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect())) != []
    # Without the filters of every row: one look at a word.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1


def test_formulas_are_the_same_in_columns_and_in_sql(spark):
    from trigramma.functions.scalar import confidence, interpolate
    from trigramma.functions.sql import definitions, register_functions

    assert definitions()["confidence"] == (["n"], "((ln((n + 1)) + 1) / (ln((n + 1)) + 2))")
    register_functions(spark)
    rows = [(1.0, 2.0, 3.0, 13.0, 5.0, 4.0), (0.0, 0.0, 0.0, 13.0, 1.0, 0.0), (1.0, 0.0, 0.0, 0.0, 2.0, 3.0)]
    names = ["n1", "n2", "n3", "c0", "c1", "c2"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    columns = df.select(confidence(F.col("n2")).alias("k"), interpolate(*map(F.col, names)).alias("p")).collect()
    text = df.selectExpr("confidence(n2) AS k", f"interpolate({', '.join(names)}) AS p").collect()
    assert [repr(tuple(r)) for r in columns] == [repr(tuple(r)) for r in text]


def test_fields_of_lines_are_found_without_arrays(spark):
    lines = {
        "a b c\t2000\t7": 7.0, "a\t\t5": 5.0, "a\t2000\t7\t8\t9": 7.0, "a\t2000\t1e3\t": 1000.0, "\t\t2": 2.0,
        "12": None, "a\t12": None, "a\t2000\t": None, "a\t2000\t\t12": None, "": None, "\t": None, "\t\t": None,
    }
    table = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = readers.parse_ngrams(table, "quarantine")
    found = parsed.collect()
    assert [r.cnt for r in found] == list(lines.values())
    assert [r.ngram for r in found] == [line.split("\t")[0] for line in lines]
    assert [r.bad_record for r in found] == [None if n is not None else line for line, n in lines.items()]
    assert readers.parse_ngrams(table, "drop").count() == 5
    assert "split" not in parsed._jdf.queryExecution().executedPlan().toString()


def test_lines_and_bad_lines_are_counted_in_one_pass(spark):
    seen = RunCounts()
    rows = kept_rows(spark.createDataFrame([("a b c\t2000\t1",), ("a b c\t2000",), ("x1 b c\t2000\t1",)], "value string"), [], "a-z", "drop", seen)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("CollectMetrics") == 2
    assert rows.count() == 1
    assert seen.get() == {"lines": 3, "bad lines": 1, "kept rows": 1}
