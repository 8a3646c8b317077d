"""The corpus pipeline: each stage against what it should keep, and the contract of its stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from periodica.llm import minhash
from periodica.llm.queries import ORACLES, QUERIES
from tests.llm.cases import words
from tests.oracle import connect, table

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    df = QUERIES[name](spark, FOLDER)
    result = connect(FOLDER).execute(ORACLES[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in result.description], result.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    item = words(rng, 40)
    near = words(rng, 150)
    shared = " ".join(words(rng, 9))
    texts = {}
    for i in range(200):
        body = words(rng, rng.randint(30, 80))
        if i % 4 == 0:
            for _ in range(3):
                body.insert(rng.randrange(30), rng.choice(("stupid", "idiot", "moron")))
        texts[i] = " ".join(body)
    for k in range(15):
        texts[300 + k] = texts[2 * k + 1] + "\n" + shared
    for k in range(4):
        copy = list(near)
        copy[10 + k] = f"other{k}"
        texts[400 + k] = " ".join(copy)
    texts[500] = " ".join(words(rng, 20) + item + words(rng, 20))
    texts[501] = " ".join(words(rng, 2000) + item[:14] + words(rng, 2000))
    rows = [(i, t, "en", f"s{i % 17}", len(t)) for i, t in texts.items()] + [(600, None, None, None, None), (601, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    def ids(frame):
        return {r.doc_id for r in frame.select("doc_id").collect()}

    now = spark.read.parquet(f"{folder}/documents.parquet")
    names = dict(corpus_pipeline.STAGES)
    assert list(names) == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
    kept = names["toxicity"](spark, now, folder)
    assert kept.columns == now.columns and ids(now) - ids(kept) == {i for i in range(200) if i % 4 == 0}
    lines = names["line_dedup"](spark, kept, folder)
    assert lines.columns == now.columns and ids(lines) == ids(kept)
    left = {r.doc_id: r for r in lines.collect()}
    assert left[300].text.endswith(shared) and left[301].text == texts[301].split("\n")[0]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in left.values())
    single = names["near_dedup"](spark, lines, folder)
    gone = ids(lines) - ids(single)
    assert gone >= {401, 402, 403} and not gone & {400, 500, 501, 600, 601} and single.columns == now.columns
    clean = names["decontaminate"](spark, single, folder)
    assert ids(single) - ids(clean) == {500} and clean.columns == now.columns
    assert ids(names["packing"](spark, clean, folder)) == ids(clean)
    assert ids(corpus_pipeline.run(spark, folder)) == ids(clean)


def test_near_dedup_takes_runs_of_five_words(spark):
    base = [f"w{i}" for i in range(100)]
    few = [f"other{i}" if i in (20, 40, 60, 80) else w for i, w in enumerate(base)]  # 91 of 107 pairs, 76 of 116 runs of five
    one = ["other" if i == 50 else w for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(few)), (3, " ".join(one))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = minhash.near_duplicates(docs, words=2, percent=80)
    assert {r.doc_id for r in pairs.where("kept").collect()} == {1}
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.collect()} == {1, 2}


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
