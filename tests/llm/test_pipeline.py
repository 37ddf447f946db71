"""Each stage of the pipeline against brute force on a small corpus, and the whole run."""

import hashlib
import random

import pytest

import corpus_pipeline as cp
from tidemark.llm import queries

random.seed(21)
WORDS = ["".join(random.choice("bcdfgaeiou") for _ in range(random.randint(3, 8))) for _ in range(600)]
BAD = ["snarkworm", "snarkling"]


def text_of(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows = []
    for i in range(300):
        t = text_of(60)
        if i % 5 == 0:
            t += " " + " ".join(random.choices(BAD, k=3))
        rows.append([i, t, random.choice(["en", "de"]), f"src{i % 3}", len(t)])
    for i in range(300, 310):
        rows.append([i, rows[i - 299][1] + " tail", "en", "src0", 1])
    for r in rows[40:60]:
        r[1] += "\n" + "a line that stands in many documents of this corpus"
    rows += [[400, None, None, None, None], [401, "", "fr", "x", 0], [None, "b c d", "en", "src1", 5]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, world):
    docs = spark.read.parquet(f"{world}/documents.parquet")
    out = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = stage(spark, docs, world)
        if name != "bpe":
            assert docs.columns == cp.COLUMNS
            docs = cp.cut(docs)
        out[name] = (before.collect(), docs.collect())
    before, after = out["toxicity"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {i for i in range(300) if i % 5 == 0} | {i for i in range(300, 310) if (i - 299) % 5 == 0}
    before, after = out["line_dedup"]
    holders = [r.doc_id for r in after if r.text and "stands in many" in r.text]
    assert holders == [max(r.doc_id for r in before if r.text and "stands in many" in r.text)] and len(before) == len(after)
    before, after = out["minhash_near_dedup"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {i for i in range(300, 310) if (i - 299) % 5}
    before, after = out["mixing"]
    tokens = lambda rows: sum(max(1, len((r.text or "").split())) for r in rows)
    assert tokens(after) >= cp.SHARE * tokens(before) - 1 and {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = out["bpe"]
    tok = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.tokenizer_path())
    texts = {r.doc_id: r.text or "" for r in before}
    assert len(after) == len(before)
    for r in after:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    assert sorted(map(repr, cp.run(spark, world).collect())) == sorted(map(repr, after))


def test_stages_on_an_empty_table(spark, world):
    docs = spark.read.parquet(f"{world}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, world)
        assert docs.count() == 0
