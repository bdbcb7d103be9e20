"""Every stage of the pipeline against brute force on the stage's own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from tallyman.llm import linededup, queries
from tallyman.llm.shared import written

from . import brute, cases
from .test_dedup import brute_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    sf = cases.DATA
    docs = cases.documents(spark, sf)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), "test")
        seen[name] = (docs, out)
        docs = out
    for name in list(seen)[:-1]:
        assert sorted(seen[name][1].columns) == sorted(COLUMNS) and dict(seen[name][1].dtypes) == dict(cases.documents(spark, sf).dtypes)
    table = lambda df: {r[0]: r[1:] for r in cases.rows_of(df, *COLUMNS)}

    before, after = map(table, seen["toxicity"])
    toxic = {r.doc_id for r in queries.op10_toxicity(spark, sf).where("predicted = 1").collect()}
    assert after == {k: v for k, v in before.items() if k not in toxic}

    before, after = map(table, seen["line dedup"])
    gone = brute_lines([(k, v[0]) for k, v in before.items()], linededup.LineParams())
    missed = 0
    for k, v in before.items():
        lines = v[0].split("\n")
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(k, []))
        if k in after:
            missed += after[k][0] != left
            assert after[k][3] == (len(after[k][0]) if after[k][0] != v[0] else v[3])
        else:
            assert not left.strip()
    assert missed <= 0.02 * len(before)  # a fuzzy pair in some fifty may share no band

    before, after = map(table, seen["near duplicates"])
    groups = brute.op8([(k, v[0]) for k, v in before.items()])
    assert after == {k: v for k, v in before.items() if groups[k][2]}

    before, after = map(table, seen["decontamination"])
    bench = cases.rows_of(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id", "text")
    hit = brute.op9([(k, v[0]) for k, v in before.items()], bench)
    assert after == {k: v for k, v in before.items() if not hit[k][4]}
    assert len(after) < len(before)

    before, packed = table(seen["packing"][0]), seen["packing"][1]
    assert {r[0] for r in cases.rows_of(packed, "doc_id")} == set(before)
    cols = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    assert sorted(cases.rows_of(corpus_pipeline.run(spark, sf), *cols)) == sorted(cases.rows_of(packed, *cols))


def test_odd_rows(spark, tmp_path):
    """Nulls, empty texts and repeated rows pass through all stages."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = [(i, t, None, "s", None) for i, t in cases.awkward_texts() if i != 126] + [(None, "words of nobody", None, None, 3), (100, None, "x", "y", 0)] * 2
    spark.createDataFrame(docs, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the cat sat")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("doc_id is null").count() >= 1 and out.where("offset < 0 or offset + length > 2048").count() == 0
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_duplicates_go_row_by_row(spark):
    text, other = "a b c d e f g h i j", "quite another text of more than five words"
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, "x"), (5, text, "x"), (5, other, "y"), (7, near, "x"), (7, near + " z", "x"), (8, other, "z"), (9, "kept", "q"), (9, "kept", "q"), (None, text, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"kept": F.lit(1), "row_key": F.lit("r")})
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    got = cases.rows_of(out, "doc_id", "text")
    assert out.columns == docs.columns
    assert sorted(g for g in got if g[0] not in (None, 7)) == [(3, text), (5, other), (9, "kept")]
    assert sum(g[0] == 7 for g in got) == 1 and (None, text) in got


def test_clashing_columns_pass_all_stages(spark):
    names = ("n_words", "spans", "items", "n_hit", "contaminated", "score", "n_lines", "n_removed", "kept_text", "kept", "component_id", "_key", "_gone", "_own", "a.b")
    docs = cases.documents(spark).withColumns({n: F.lit(n) for n in names})
    before = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, cases.DATA), "test")
        assert docs.columns == before
    assert all(r[n] == n for r in docs.collect() for n in names)
    plain = {r.doc_id: r.text for r in docs.collect()}
    docs = cases.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, cases.DATA), "test")
    assert plain == {r.doc_id: r.text for r in docs.collect()}
