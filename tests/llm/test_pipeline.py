"""Each stage on its own input, and the chain."""

import inspect

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from headway.llm.queries import ORACLES, QUERIES
from tests.llm.cases import SCHEMA, documents
from tests.llm.test_corpus import check_sequences, components_of, leaked, overlap_of, passages_removed, simhash_of

FOLDER = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_shape():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxicity_stage_keeps_the_rest(spark, docs):
    got = stage("toxicity")(spark, docs, FOLDER)
    assert got.columns == docs.columns
    scored = QUERIES["op3_toxicity"](spark, FOLDER)
    want = {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    assert {r["doc_id"] for r in got.collect()} == want


def test_line_stage(spark, docs):
    got = {r["doc_id"]: r for r in stage("line_dedup")(spark, docs, FOLDER).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    gone = passages_removed(rows, 3, corpus_pipeline.PASSAGE_WORDS)
    for i, t in rows:
        left = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
        if gone[i] and not left.split():
            assert i not in got
        else:
            assert got[i]["text"] == left and got[i]["n_chars"] == len(left)


def test_passages_of_one_line_go(spark, monkeypatch):
    """A repeated line of many words reaches the packing once, a short one each time."""
    long, short = " ".join(f"w{i}" for i in range(50)), "a short line"
    texts = [f"{long}\nits own {i * 'end '}\n{short}" for i in range(3)]
    docs = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(texts)], "doc_id long, text string, n_chars int")
    reader = type("Reader", (), {"parquet": lambda self, path: docs})()
    session = type("Session", (), {"read": reader})()
    seen = []
    stages = [(n, f if n == "line_dedup" else lambda s, d, _: d) for n, f in corpus_pipeline.STAGES[:-1]]
    monkeypatch.setattr(corpus_pipeline, "prepare", lambda s: None)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*stages, ("packing", lambda s, d, _: seen.append(d) or d)])
    got = {r["doc_id"]: r for r in corpus_pipeline.run(session, "none").collect()}
    assert seen and got[0]["text"] == texts[0]
    assert all(got[i]["text"] == texts[i].split("\n", 1)[1] and got[i]["n_chars"] == len(got[i]["text"]) for i in (1, 2))


def test_near_stage(spark, docs):
    got = {r["doc_id"] for r in stage("near_dedup")(spark, docs, FOLDER).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: simhash_of(t) for i, t in texts.items()}
    root = components_of(set(prints.values()))
    least = {}
    for i, f in prints.items():
        least[root[f]] = min(least.get(root[f], i), i)
    left = sorted(least.values())
    copies = {b for n, b in enumerate(left) for a in left[:n] if overlap_of(texts[a], texts[b]) >= 0.8}
    assert copies and got == set(left) - copies


def test_decontamination_stage(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    out = stage("decontamination")(spark, docs, FOLDER)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    cut = 0
    for r in docs.collect():
        hit = leaked(r["text"], items, 10)[1] if any(t[:30].lower() in r["text"].lower() for _, t in items) else None
        if hit:
            cut += 1
            assert r["doc_id"] not in got or len(got[r["doc_id"]]["text"]) < len(r["text"])
        elif hit is not None:
            assert got[r["doc_id"]]["text"] == r["text"]
    assert cut
    again = stage("decontamination")(spark, out, FOLDER)
    assert again.exceptAll(out).count() == 0


def test_whole_chain(spark):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert got and check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], 2048)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_rows_pass_every_stage(spark, name, tmp_path):
    frame = spark.createDataFrame(documents(), SCHEMA).withColumns({"predicted": F.lit("own"), "leak_spans": F.lit("own"), "n_chars": F.lit(1)})
    spark.createDataFrame([(5, 1), (3, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a line that is not there at all in any of the texts")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(name)(spark, frame, str(tmp_path))
    if name != "packing":
        assert out.columns == frame.columns
    out.collect()
    assert stage(name)(spark, frame.limit(0), str(tmp_path)).count() == 0


SQL = sorted(ORACLES)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    import duckdb

    from check import TABLES, rows_of

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
