"""Quality rules in DataFrame functions only: counts, repetition, and divergence from a language.

Base rules count words, symbols, repeated lines and repeated five-word windows. The method's verdict
compares two histograms of a document with those of its language, by Jensen-Shannon distance (base 2,
0 to 1): of character classes, and of common words. References are sums over all documents that pass
the base rules and are long enough, by language; a short document is not judged by divergence.

Words are maximal runs outside `\\x20\\x09-\\x0D`. Windows are compared by 64-bit hashes of their words.

Edge cases: null and empty texts have no words and so fail the base rules. A document whose language
is null, or has no word list, is compared with the nearest of all references; where there is no
reference at all only the base rules count. Repeated rows give repeated rows (and count twice in the
references); an empty table gives an empty table; columns of other names are kept as they are, and
the ones made here have names no input has until they are returned.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import own_name, settled

SPACE = "[\\x20\\x09-\\x0D]+"
WINDOW = 5

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "at", "by", "this", "are", "from"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "avec"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "für"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}

#: Character classes as regular expressions both Java and RE2 read alike; the rest is one more class.
#: No character is in two of them.
CLASSES = {
    "lower": "[\\p{Ll}]+", "upper": "[\\p{Lu}]+", "digit": "[\\p{Nd}]+", "space": SPACE,
    "stop": "[.,;:!?'\"()-]+", "symbol": "[#*$%&|<>@=+/_~^{}\\[\\]]+",
}


@dataclass(frozen=True)
class Rules:
    least_words: int = 10
    repeat_percent: int = 20  # of the words, those in repeated windows
    judged_words: int = 80  # fewer words are not judged by divergence
    char_distance: float = 0.27
    word_distance: float = 0.31
    common: dict[str, list[str]] = field(default_factory=lambda: COMMON_WORDS)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def without(text: Column, pattern: str) -> Column:
    """How many characters of the text match the pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def paired(left: Column, right: Column, ahead: int) -> Column:
    """One hash per place of left: of its element and the element of right that many places ahead, if any."""
    return F.zip_with(left, F.slice(right, F.lit(1 + ahead), F.size(left)), lambda a, b: F.xxhash64(a, b))


def repeat_words(windows: Column) -> Column:
    """The words that lie in a window found twice or more in the same text, from the hashes of its windows."""
    # Sorted by hash, a repeated window stands beside its like; sorted by place again, each
    # repeated window covers what the next one does not.
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = let(placed, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | ((k > 0) & (x["h"] == F.get(s, k - 1)["h"]))),
        lambda x: x["i"])))
    each = let(twice, lambda p: F.transform(
        p, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - at, F.lit(WINDOW)))))
    covered = F.aggregate(each, F.lit(0), lambda total, n: total + n)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def common_hashes(words: Column, listed: list[str]) -> Column:
    """Hashes of the words, lower-cased in A-Z, with all that are listed and few others."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    longest = max(len(w.encode()) for w in listed)
    # Words that are equal but for A-Z are equal in lower case, so the quick filter loses none.
    near = F.filter(words, lambda x: (F.octet_length(x) <= longest) & F.lower(x).isin(*[F.lower(F.lit(w)) for w in listed]))
    return F.transform(near, lambda x: F.when(x.isin(listed), F.xxhash64(x)).otherwise(F.xxhash64(F.translate(x, upper, lower))))


def measured(df: DataFrame, text: str, lang: str, rules: Rules, prefix: str = "") -> DataFrame:
    """The rows with their base counts and histograms, in columns that begin with the prefix.

    A text is searched once, for its words. What follows works on words, hashes, or the characters
    that the classes before have left. Values used twice are columns, which Spark computes once.
    """
    n = lambda c: F.col(prefix + c)
    out = df.withColumn(prefix + "text", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn(prefix + "words", words_of(n("text")))
    out = out.withColumns({
        prefix + "n_chars": F.length(n("text")),
        prefix + "n_words": F.size(n("words")).cast("long"),
        prefix + "n_dup_lines": repeated_lines(n("text")).cast("long"),
        prefix + "left": F.array_join(n("words"), ""),
        prefix + "pairs": paired(n("words"), n("words"), 1),
        prefix + "common": common_hashes(n("words"), sorted({w for listed in rules.common.values() for w in listed})),
    }).drop(prefix + "text")
    out = out.withColumn(prefix + "fours", paired(n("pairs"), n("pairs"), 2)).drop(prefix + "pairs")
    windows = F.slice(paired(n("fours"), n("words"), 4), F.lit(1), F.greatest(F.size(n("words")) - (WINDOW - 1), F.lit(0)))
    out = out.withColumn(prefix + "windows", windows).drop(prefix + "fours", prefix + "words")
    out = out.withColumns({
        prefix + "word_chars": F.length(n("left")).cast("long"),
        prefix + "n_repeat_words": repeat_words(n("windows")).cast("long"),
        prefix + "space": n("n_chars") - F.length(n("left")),
    }).drop(prefix + "windows", prefix + "n_chars")
    for name, pattern in CLASSES.items():
        if name == "space":
            continue
        if name == "symbol":
            out = out.withColumn(prefix + "n_symbols", without(n("left"), "[#*$%&|<>]+").cast("long"))
        out = out.withColumn(prefix + "next", F.regexp_replace(n("left"), pattern, ""))
        out = out.withColumns({prefix + name: F.length(n("left")) - F.length(n("next")), prefix + "left": n("next")})
    common = F.lit(None).cast("array<int>")
    for code, listed in reversed(rules.common.items()):
        counts = F.array(*[F.size(n("common")) - F.size(F.array_remove(n("common"), F.xxhash64(F.lit(w)))) for w in listed])
        common = F.when(F.col(lang) == code, counts).otherwise(common)
    # The last bin of each histogram is the rest.
    out = out.withColumns({prefix + "classes": F.array(*[n(c) for c in CLASSES], F.length(n("left"))), prefix + "common": common})
    failed = (n("n_words") < rules.least_words) | (100 * n("n_repeat_words") > rules.repeat_percent * n("n_words"))
    return out.withColumns({
        prefix + "base_failed": failed,
        prefix + "common": let(n("common"), lambda c: F.concat(c, F.array(n("n_words").cast("int") - F.aggregate(c, F.lit(0), lambda a, b: a + b)))),
    }).drop(prefix + "left", prefix + "next", *[prefix + c for c in CLASSES])


def references(features: DataFrame, lang: str, rules: Rules, prefix: str = "") -> DataFrame:
    """One row per language that has a word list: its histograms over all judged documents.

    At most as many rows as the rules have languages.
    """
    used = features.filter(F.col(lang).isin(list(rules.common)) & ~F.col(prefix + "base_failed") & (F.col(prefix + "n_words") >= rules.judged_words))
    classes = [F.sum(F.col(prefix + "classes")[i].cast("long")).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    widest = max(len(w) for w in rules.common.values()) + 1
    common = [F.sum(F.get(F.col(prefix + "common"), F.lit(i)).cast("long")).alias(f"w{i}") for i in range(widest)]
    sums = used.groupBy(F.col(lang).alias("ref_lang")).agg(*classes, *common)
    return sums.select(
        "ref_lang", F.array(*[f"c{i}" for i in range(len(CLASSES) + 1)]).alias("ref_classes"),
        F.filter(F.array(*[f"w{i}" for i in range(widest)]), lambda x: x.isNotNull()).alias("ref_common"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of one length; null if either is empty."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)

    def part(x: Column, other: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + other))).otherwise(F.lit(0.0))

    def divergence(p: Column, q: Column) -> Column:
        return total(F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2))

    shares = lambda c: let(total(c), lambda t: F.transform(c, lambda x: x / t))
    found = let(shares(counts), lambda p: let(shares(reference), lambda q: F.sqrt(F.greatest(F.lit(0.0), divergence(p, q)))))
    return F.when((total(counts) > 0) & (total(reference) > 0), found)


def judged(features: DataFrame, refs: DataFrame, lang: str, rules: Rules, prefix: str = "") -> DataFrame:
    """The features with char_distance, word_distance and kept.

    The references, at most one row per word list, become constants of the expressions.
    """
    n = lambda c: F.col(prefix + c)
    found = {r["ref_lang"]: r for r in refs.collect()}

    def constant(name: str) -> Column:
        pairs = [x for code, r in found.items() for x in (F.lit(code), F.array(*[F.lit(c) for c in r[name]]))]
        return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,array<bigint>>")

    code = F.coalesce(F.col(lang), F.lit(""))
    own = F.try_element_at(constant("ref_classes"), code)
    nearest = F.array_min(F.transform(F.map_values(constant("ref_classes")), lambda r: distance(n("classes"), r)))
    out = features.withColumns({
        prefix + "char_distance": F.when(own.isNotNull(), distance(n("classes"), own)).otherwise(nearest),
        prefix + "word_distance": distance(n("common"), F.try_element_at(constant("ref_common"), code)),
    })
    far = (F.coalesce(n("char_distance"), F.lit(0.0)) > rules.char_distance) | (F.coalesce(n("word_distance"), F.lit(0.0)) > rules.word_distance)
    return out.withColumn(prefix + "kept", ~n("base_failed") & ~((n("n_words") >= rules.judged_words) & far))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality(df: DataFrame, key: str, text: str, lang: str, rules: Rules = Rules()) -> DataFrame:
    """Per row: key, the base counts, base_failed, char_distance, word_distance and kept.

    The measures are written once, without the texts, since the references need a pass of their own.
    """
    used = df.select(F.col(key).alias("key"), F.col(text).alias("source_text"), F.col(lang).alias("source_lang"))
    features = settled(measured(used, "source_text", "source_lang", rules).drop("source_text"), "quality-features")
    found = judged(features, references(features, "source_lang", rules), "source_lang", rules)
    return found.select(F.col("key").alias(key), *BASE, "char_distance", "word_distance", "kept")


def keep_good(df: DataFrame, text: str, lang: str, rules: Rules = Rules()) -> DataFrame:
    """The rows that the rules keep, with the columns they came with.

    The rows are written once with their measures, since the references need a pass of their own and
    the measures cost more than the writing.
    """
    prefix = own_name("quality") + "_"
    rows = df.withColumn(prefix + "lang", F.col(lang))
    rows = settled(measured(rows, text, prefix + "lang", rules, prefix), "quality-measured")
    refs = references(rows, prefix + "lang", rules, prefix)
    found = judged(rows, refs, prefix + "lang", rules, prefix)
    return found.filter(F.col(prefix + "kept")).select(*[F.col(f"`{c}`") for c in df.columns])
