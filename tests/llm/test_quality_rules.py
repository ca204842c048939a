"""Quality rules against plain counting, and against SQL."""

import collections
import math
import re
import unicodedata

from pyspark.sql import functions as F

from suite import check
from tablesync.llm import quality_rules as q, queries
from tests.llm.helpers import awkward, documents, prose


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = collections.Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if count[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def measured(spark, rows, **rules):
    out = q.quality(documents(spark, rows), "doc_id", "text", "lang", q.Rules(**rules))
    return [(r["doc_id"], tuple(r[c] for c in q.BASE), r) for r in out.collect()]


def test_base_counts(spark):
    sentence = prose(1, 12)
    rows = awkward() + [
        (50, f"{sentence}\n{sentence}\n \n\n{sentence} x"), (51, "a b c d e a b c d e f " + prose(2, 80)), (52, "a " * 50), (53, "x #$ | <> && %% ** " * 3),
        (54, prose(3, 30) + " q r s t u " + prose(4, 30) + " q r s t u v"), (55, "é̀   ü z \x85 " + prose(5, 12)),
    ]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((k, b) for k, b, _ in measured(spark, rows)), key=key) == sorted(((k, brute(t)) for k, t in rows), key=key)


def test_distance(spark):
    def plain(p, r):
        p, r = [x / sum(p) for x in p], [x / sum(r) for x in r]
        side = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        return math.sqrt(max(0, (side(p, r) + side(r, p)) / 2))

    rows = [([1, 2, 3], [3, 2, 1]), ([5, 0, 0], [0, 1, 1]), ([2, 2, 0], [1, 1, 0]), ([0, 0, 0], [1, 1, 1])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select(q.distance(F.col("a"), F.col("b")).alias("d"))
    for r, (a, b) in zip(df.collect(), rows):
        assert r["d"] is None if not sum(a) else abs(r["d"] - plain(a, b)) < 1e-12
    assert abs(plain([5, 0, 0], [0, 1, 1]) - 1) < 1e-12


def histograms(text, lang):
    kinds = {"lower": lambda c: unicodedata.category(c) == "Ll", "upper": lambda c: unicodedata.category(c) == "Lu",
             "digit": lambda c: unicodedata.category(c) == "Nd", "space": lambda c: c in " \t\n\v\f\r",
             "stop": lambda c: c in ".,;:!?'\"()-", "symbol": lambda c: c in "#*$%&|<>@=+/_~^{}[]"}
    classes = [sum(map(kinds[k], text)) for k in q.CLASSES]
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    common = [lowered.count(w) for w in q.COMMON_WORDS.get(lang, [])]
    return classes + [len(text) - sum(classes)], common + [len(lowered) - sum(common)] if common else None


def test_histograms(spark):
    texts = [
        "The THE the tHe of, a#b <i> 100% (x) [y] é É ß ǅ ʰ 中文 \U0001d44e \U0001d400 \U0001f600 ١٢ \x85 \u2028 Ⅷ ª", "für FÜR FüR Für fÜR De LA la que QUE El y Y",
        "İn iS \u212a as A\u030a \u017fe se SE \u017fich", "", " \t\n\v\f\r ", "the", " and\u00a0the the\x00the ", "nicht NICHT nichts \x1f in \x1c zu",
    ]
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for t in texts for lang in ("en", "de", "es", "fr", "xx", None))]
    found = q.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", q.Rules()).collect()
    assert {r["doc_id"]: (r["classes"], r["common"]) for r in found} == {i: histograms(t, lang) for i, t, lang in rows}


def test_windows_around_their_length(spark):
    rows = [(n, " ".join("ab"[i % k // (k - 1)] for i in range(n))) for k in (2, 3) for n in range(14)]
    assert sorted((k, b) for k, b, _ in measured(spark, rows)) == sorted((k, brute(t)) for k, t in rows)


def test_a_text_is_searched_once(spark):
    """Not once per character class and common word: passes over whole texts are what costs."""
    df = documents(spark, awkward()).select("doc_id", "text", "lang")
    plan = q.measured(df, "text", "lang", q.Rules())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text#") == 2  # words and lines
    assert not re.search(r"replace\((text|spaced)#|translate\(array_join", plan)


def english(seed, n):
    listed = q.COMMON_WORDS["en"] * 2
    return " ".join(x if i % 3 else listed[i % len(listed)] for i, x in enumerate(prose(seed, n).split()))


def test_divergent_documents_are_rejected(spark):
    rows = [(k, english(k, 200)) for k in range(30)]
    rows += [(100, " ".join(f"{x}%%%$$$###" for x in prose(7, 200).split()).upper()), (101, english(200, 70) + " ###" * 9), (102, english(201, 200), None), (103, english(202, 200), "xx")]
    kept = {k: r["kept"] for k, _, r in measured(spark, rows)}
    assert not kept.pop(100) and all(kept.values())
    assert all(r["char_distance"] is not None for k, _, r in measured(spark, rows) if k in (102, 103))


def test_without_any_reference_only_base_rules_count(spark):
    rows = [(1, prose(1, 200), "xx"), (2, None, None), (3, prose(2, 5), "yy")]
    assert {k: r["kept"] for k, _, r in measured(spark, rows)} == {1: True, 2: False, 3: False}


def test_rows_pass_with_their_columns(spark):
    rows = awkward()
    df = documents(spark, rows)
    kept = q.keep_good(df, "text", "lang")
    assert kept.columns == df.columns
    decided = sorted((k is None, k or 0) for k, _, r in measured(spark, rows) if r["kept"])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == decided
    assert q.keep_good(documents(spark, []), "text", "lang").collect() == [] and measured(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = documents(spark, awkward()).select("doc_id", "text", "lang")
    features = q.measured(df, "text", "lang", q.Rules())
    refs = q.references(features, "lang", q.Rules())
    for frame in (features, refs, q.judged(features, refs, "lang", q.Rules())):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|NestedLoop|Cartesian", plan)


def test_query(spark, data, monkeypatch):
    monkeypatch.setattr(check, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check, "ORACLES", queries.ORACLES)
    assert check.compare(spark, data, "op6_quality_rules")[0] == "match"
