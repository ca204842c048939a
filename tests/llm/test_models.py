"""Language and quality by held-out accuracy, by hand-made evidence, and on awkward rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tablesync.llm import language as lg, quality_model as qm
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, prose

SOUNDS = {"en": "the ing and th er on re", "de": "sch der und ung ein ch ß", "fr": "que eau le ment é la oi"}


def speech(code, seed, n):
    rng = random.Random(f"{code}{seed}")
    parts = SOUNDS[code].split()
    return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n))


def spoken(spark, extra=()):
    rows = [(20_000 + k * 10 + i, speech(c, k, 40), c, f"{c}.example.{c}") for k in range(40) for i, c in enumerate(SOUNDS)]
    return rows, documents(spark, rows + list(extra))


def identified(df, p=lg.Fusion(), suffix=False):
    out = lg.identify(df, "doc_id", "text", "lang", "source", lg.suffix_of(F.col("source")) if suffix else None, p)
    return {r["doc_id"]: r for r in out.collect()}


def test_text_outweighs_a_wrong_declaration(spark):
    wrong = [(9000 + k, speech("fr", 900 + k, 40), "en", "mixed") for k in range(5)]
    rows, df = spoken(spark, wrong)
    out = identified(df)
    assert all(out[k]["language"] == c and out[k]["kept"] for k, _, c, _ in rows)
    assert all(out[k]["language"] == "fr" for k, *_ in wrong)


def test_other_evidence_decides_where_the_text_is_silent(spark):
    silent = "12 34 oo"
    extra = [(9001, silent, "de", None), (9002, silent, None, "de.example.de"), (9003, silent, None, "new.fr"), (9004, "12 34", "de", None)]
    _, df = spoken(spark, extra)
    out = identified(df, lg.Fusion(least_letters=1), suffix=True)
    assert [out[k]["language"] for k in (9001, 9002, 9003)] == ["de", "de", "fr"]
    assert not out[9004]["kept"] and out[9004]["letters"] == 0


def test_sparse_hosts_are_drawn_to_their_suffix(spark):
    extra = [(9001, "oo", None, "tiny.de"), (9002, speech("fr", 999, 30), None, "tiny.de")]
    _, df = spoken(spark, extra)
    assert identified(df, lg.Fusion(least_letters=1), suffix=True)[9001]["language"] == "de"


def test_languages_wanted(spark):
    rows, df = spoken(spark)
    out = identified(df, lg.Fusion(wanted=("fr",)))
    assert all(out[k]["kept"] == (c == "fr") for k, _, c, _ in rows)


def test_languages_without_a_model_keep_their_declaration(spark):
    extra = [(9000 + k, speech("de", 900 + k, 40), "xx", "x.example.en") for k in range(3)] + [(9100, "12 34", "xx", None), (9101, speech("fr", 990, 40), " ", None)]
    rows, df = spoken(spark, extra)
    out = identified(df)
    assert all((out[k]["language"], out[k]["confidence"], out[k]["kept"]) == ("xx", None, True) for k in range(9000, 9003))
    assert (out[9100]["language"], out[9100]["kept"], out[9101]["language"]) == ("xx", False, "fr")
    assert all(out[k]["language"] == c and out[k]["kept"] for k, _, c, _ in rows)
    two = identified(df, lg.Fusion(most_languages=2, wanted=("fr", "de")))
    assert all(two[k]["language"] == c and two[k]["kept"] == (c != "en") for k, _, c, _ in rows)
    kept = {r["doc_id"] for r in lg.keep_known(df, "doc_id", "text", "lang", "source", lg.Fusion(most_languages=2)).collect()}
    assert kept == {k for k, *_ in rows} | {9000, 9001, 9002, 9101}


def test_many_languages(spark):
    def coded(c, k, n=40):
        rng = random.Random(f"{c}-{k}")
        return " ".join(f"{chr(97 + c // 26)}{chr(97 + c % 26)}{rng.choice('aeiou')}{chr(97 + c % 26)}" for _ in range(n))

    rows = [(c * 100 + k, coded(c, k), f"l{c:02}", f"s{c}") for c in range(70) for k in range(5)]
    out = identified(documents(spark, rows))
    assert all(out[k]["language"] == c and out[k]["kept"] for k, _, c, _ in rows)
    assert len({r["language"] for r in out.values() if r["confidence"] is not None}) == 64


def test_language_of_repeated_ids(spark):
    """A row goes by its own text, not because another row has its id."""
    extra = [(k, "12 34", "en", None) for k in (20_000, 20_011)] + [(20_000, "", None, None)]
    rows, df = spoken(spark, extra)
    kept = lg.keep_known(df, "doc_id", "text", "lang", "source").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted((k, t) for k, t, *_ in rows)


def test_language_awkward_rows(spark):
    extra = [(k, t, None, None) for k, t in awkward()] + [(9003, speech("en", 5, 30), "zz", None)]
    rows, df = spoken(spark, extra)
    out = lg.identify(df, "doc_id", "text", "lang", "source").collect()
    assert len(out) == len(rows) + len(extra)
    silent = [r for r in out if r["doc_id"] in (1, 2, 3)]
    assert all(not r["kept"] and r["letters"] == 0 and r["language"] for r in silent)
    kept = lg.keep_known(df, "doc_id", "text", "lang", "source")
    assert kept.columns == df.columns
    gone = {r["doc_id"] for r in df.collect()} - {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3} <= gone and None not in gone and not gone & {k for k, *_ in rows}
    assert lg.identify(documents(spark, []), "doc_id", "text", "lang", "source").collect() == []
    few = lg.identify(documents(spark, [(1, "ab cd")]), "doc_id", "text", "lang", "source").collect()
    assert [(r["language"], r["kept"]) for r in few] == [(None, False)]


def test_language_queries(spark, data):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, data).collect()}
    assert out.keys() == docs.keys()
    assert sum(out[k]["language"] == r["lang"] for k, r in docs.items()) >= 0.99 * len(docs)
    pages = lg.of_pages(spark.read.parquet(f"{data}/pages.parquet"), "page_id", "url", "html", lg.Fusion(least_rows=1)).collect()
    assert len(pages) == spark.read.parquet(f"{data}/pages.parquet").count() and all(r["language"] for r in pages)


def test_trigrams():
    data = np.frombuffer("Ab é".encode(), dtype=np.uint8)
    bucket, at, letters = lg.trigrams(data, np.array([0, 3, len(data)]), 1 << 14)
    assert letters.tolist() == [2, 1] and np.diff(at).tolist() == [2, 2] and len(bucket) == 4


def junk(seed):
    return " ".join(f"{w.upper()}!!###" for w in prose(seed, 3).split() * 15)


def labelled(spark):
    rows = [(k, junk(k) if k % 3 == 0 else prose(k, 60), "en", "bad.example" if k % 3 == 0 else f"site{k % 7}.example") for k in range(300)]
    labels = spark.createDataFrame([(k, 0 if k % 3 == 0 else 1, 5) for k in range(200)] + [(None, 1, 5), (7, None, 5), (99_999, 0, 5)], "doc_id long, quality int, good int")
    return rows, labels


def assessed(df, labels, **kw):
    return {r["doc_id"]: r for r in qm.quality(df, labels, "doc_id", "text", "quality", "source", "lang", **kw).collect()}


def test_held_out_rows_are_judged_right(spark):
    rows, labels = labelled(spark)
    out = assessed(documents(spark, rows), labels)
    assert all(out[k]["kept"] == (k % 3 != 0) for k, *_ in rows if k >= 200)


def test_sites_shift_doubtful_documents_by_their_size(spark):
    rows, labels = labelled(spark)
    doubtful = " ".join([*prose(1, 30).split(), *junk(2).split()[:14]])
    rows += [(1000, doubtful, "en", "bad.example"), (1001, doubtful, "en", "site1.example"), (1002, doubtful, "en", "new.example"), (1003, doubtful, None, None)]
    out = assessed(documents(spark, rows), labels)
    assert len({round(out[k]["evidence"], 12) for k in (1000, 1001, 1002, 1003)}) == 1
    assert out[1000]["quality"] < out[1003]["quality"] < out[1001]["quality"]
    assert abs(out[1002]["quality"] - out[1003]["quality"]) < 1e-9


def test_quality_awkward_rows(spark):
    rows, labels = labelled(spark)
    rows += [(5000, None, None, None), (5001, "", "en", None), (5001, "", "en", None), (None, prose(9, 60), None, "s"), (5002, prose(8, 40_000), "en", "site1.example")]
    out = qm.quality(documents(spark, rows), labels, "doc_id", "text", "quality", "source", "lang").collect()
    assert len(out) == len(rows) and all(0 <= r["quality"] <= 1 and r["kept"] is not None for r in out)
    none = assessed(documents(spark, rows), labels.filter("quality = 1"))
    assert all(r["kept"] and r["evidence"] == 0.5 for r in none.values())
    assert qm.quality(documents(spark, []), labels, "doc_id", "text", "quality", "source", "lang").collect() == []


def test_sample_is_bounded(spark):
    rows, labels = labelled(spark)
    x, y = qm.sample(documents(spark, rows), labels, "doc_id", "text", "quality", qm.Quality(sample=50))
    assert len(y) == 50 and x.shape == (50, len(qm.MEASURES))


def test_quality_query_on_held_out_labels(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1
    out = {r["doc_id"]: r["kept"] for r in qm.quality(docs, labels.filter(~held), "doc_id", "text", "quality", "source", "lang").collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.filter(held).collect()}
    clean = [out[k] for k, q in truth.items() if q == 1 and zlib.crc32(str(k).encode()) % 2 == 1]
    assert sum(clean) >= 0.95 * len(clean) and sum(out[k] == bool(q) for k, q in truth.items()) >= 0.85 * len(truth)
    assert QUERIES["op8_quality_model"](spark, data).count() == docs.count()
