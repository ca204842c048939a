import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablesync.llm import merkle
from tablesync.llm.queries import QUERIES

from .helpers import awkward, documents, prose

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hashed(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(nodes, fan=8):
    """Root, and per node the list of (before, after) up to it."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            start = p // fan * fan
            proofs[i].append(("".join(nodes[start:p]), "".join(nodes[p + 1 : start + fan])))
        nodes = [sha("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
        at = [p // fan for p in at]
    return nodes[0], proofs


def brute(rows, fan=8):
    """(doc_id, leaf, subroot, root, digest of the proof, folded root) of every row, in any order."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row["lang"]].append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    sub = {}
    for lang in order:
        part = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, hashed(r)))
        sub[lang] = (part, *tree([hashed(r) for r in part], fan))
    root, tops = tree([sub[x][1] for x in order], fan)
    out = []
    for lang, top in zip(order, tops):
        part, subroot, proofs = sub[lang]
        for row, proof in zip(part, proofs):
            proof = proof + top
            changed = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            node = hashed(changed)
            for before, after in proof:
                node = sha(before + node + after)
            out.append((row["doc_id"], hashed(row), subroot, root, sha("".join(b + a for b, a in proof)), node))
    return out


def found(df, **options):
    when = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 3 == 0
    out = merkle.manifest(df, "doc_id", COLUMNS, "lang", {"text": merkle.tampered_text(F.col("text"))}, when, **options)
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root")
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_many_levels_against_plain_trees(spark, levels):
    rows = [(i, f"Text {i} OF {prose(i, 5)}", "en" if i % 3 else "fr", "s") for i in range(150)]
    rows += [(1000 + i, f"Lone {i}", f"l{i}") for i in range(20)] + [(2000 + i, "Same", None) for i in range(9)]
    df = documents(spark, rows)
    assert Counter(found(df, m=merkle.Merkle(levels=levels))) == Counter(brute([r.asDict() for r in df.collect()]))


def test_other_fan(spark):
    df = documents(spark, [(i, f"A{i}", "en") for i in range(37)])
    assert Counter(found(df, m=merkle.Merkle(fan=3, levels=2))) == Counter(brute([r.asDict() for r in df.collect()], 3))


def test_awkward_rows(spark):
    rows = awkward() + [(20, "B", None), (21, "B", ""), (22, "B", "ä"), (None, "X", None), (10, prose(2, 50))] + [(7, "tie", "en", None)] * 30
    df = documents(spark, rows)
    want = brute([r.asDict() for r in df.collect()])
    assert Counter(found(df)) == Counter(want) == Counter(found(df, m=merkle.Merkle(levels=1)))


@pytest.mark.parametrize("rows", [[], [(1, "only")], [(1, None, None)]])
def test_few_rows(spark, rows):
    df = documents(spark, rows)
    assert Counter(found(df)) == Counter(brute([r.asDict() for r in df.collect()]) if rows else [])


def test_only_changed_rows_fail(spark):
    df = documents(spark, [(i, "Upper" if i % 2 else "lower", "en") for i in range(100)])
    out = merkle.manifest(df, "doc_id", COLUMNS, "lang", {"text": F.upper("text")}, F.col("doc_id") < 10)
    assert {r.doc_id for r in out.collect() if r.folded_root != r.root} == set(range(10))
    proof = out.filter("doc_id = 99").first().proof
    assert [len(s.before + s.after) // 64 for s in proof] == [3, 4, 1]


def test_query(spark, data):
    rows = [r.asDict() for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op12_merkle"](spark, data).collect()]
    assert Counter(got) == Counter((*r, r[-1] == r[3]) for r in brute(rows))
