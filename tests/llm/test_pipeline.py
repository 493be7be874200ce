import importlib.util
import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acervo.llm import byte_bpe, decontaminate, simhash, toxicity


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(1)
    folder = tmp_path_factory.mktemp("tables")
    words = lambda n: " ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 4) + rnd.choice("xyz") * rnd.randrange(3) for _ in range(n))
    item = words(30)
    rows, labels = [], []
    for i in range(400):
        text = words(rnd.randrange(20, 90))
        if i % 4 == 0:
            text += " awful rotten vilest " + words(10) + " awful rotten"
        rows.append([i, text, "en", "src0", len(text)])
        labels.append((i, 1, int(i % 4 == 0)))
    rows[1][1] = words(20) + " " + item + " " + words(20)
    rows[2][1] += " mail a.b1@x.example.com now"
    rows += [[1000 + i, rows[3][1], "en", "src1", 0] for i in range(30)]
    rows += [[2000, None, None, None, None], [2001, "", "en", "x", 0], [None, words(15), "en", "x", 0], [5, rows[5][1], "en", "src0", rows[5][4]]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    labels, benchmark = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    model = toxicity.fit(docs, labels)
    score = lambda text: float(model.curve(toxicity.passages(toxicity.words((text or "").encode()), model.odds, model.law)[0]))
    kept = stages["toxicity"](spark, docs, sf_dir).cache()
    assert kept.columns == columns
    assert rows_of(kept) == sorted(str(tuple(r)) for r in docs.collect() if score(r["text"]) < toxicity.THRESHOLD)
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & set(range(0, 400, 4)) and set(range(400)) - set(range(0, 400, 4)) <= ids

    groups = {}
    for r in kept.collect():
        fp = simhash.fingerprint((r["text"] or "").encode()) & (1 << 64) - 1
        near = [k for k in groups if (k ^ fp).bit_count() <= 3]
        own = [r] + [x for k in near for x in groups.pop(k)]
        for x in own:
            groups[simhash.fingerprint((x["text"] or "").encode()) & (1 << 64) - 1] = own
    stay = {id(g): min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()}
    kept = stages["near_duplicates"](spark, kept, sf_dir).cache()
    assert rows_of(kept) == sorted(str(tuple(r)) for r in stay.values())

    block = decontaminate.Block(decontaminate.pieces_of(0, benchmark.first()["text"].encode()), decontaminate.MAX_EDIT, 0.99)
    piece = block.pieces[0][1]
    clean = []
    for r in kept.collect():
        edits, _, _ = decontaminate.least_edits(piece, decontaminate.numbers(decontaminate.tokens((r["text"] or "").encode())))
        if edits > decontaminate.edits_allowed(len(piece)):
            clean.append(str(tuple(r)))
    kept = stages["benchmark_passages"](spark, kept, sf_dir).cache()
    assert rows_of(kept) == sorted(clean) and kept.filter("doc_id = 1").count() == 0

    after = stages["personal_data"](spark, kept, sf_dir).cache()
    assert after.columns == columns and after.count() == kept.count()
    old = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert [r["doc_id"] for r in after.collect() if r["text"] != old[r["doc_id"]]] == [2]

    encoded = stages["tokens"](spark, after, sf_dir)
    coder = byte_bpe.coder(byte_bpe.public_tokenizers.path(byte_bpe.RANKS), byte_bpe.public_tokenizers.PATTERN)
    for r in encoded.collect():
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"])
        assert coder.decode(byte_bpe.np.array(r["ids"], dtype=int)) == (r["text"] or "").encode()


def test_run_is_the_stages_in_turn(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted(map(str, rows)) == sorted(map(str, docs.collect()))


def test_tables_without_rows(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_pass_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in ("fp", "_k1", "toxicity", "n_tokens", "ids", "round_trip", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert out.filter("fp = 'fp' and _k1 = '_k1' and ids = 'ids' and n_tokens = 'n_tokens' and `a.b` = 'a.b'").count() == out.count() > 0
        assert name == "tokens" or len(out.columns) == len(docs.columns)
    out.write.parquet(sf_dir + "/passed-through")


def test_only_the_package_itself_uses_llm():
    root = os.path.dirname(importlib.util.find_spec("corpus_pipeline").origin)
    for folder, _, files in os.walk(os.path.join(root, "acervo")):
        if os.path.basename(folder) == "llm" or f"{os.sep}llm{os.sep}" in folder + os.sep:
            continue
        for file in files:
            if file.endswith(".py"):
                assert "acervo.llm" not in open(os.path.join(folder, file), encoding="utf-8").read()
