"""Each stage of the pipeline against what its operator decides, and the entry's guard."""

import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from tablesync.llm import language, quality_rules
from tablesync.llm.base import settled
from tests.llm.test_byte_bpe import expected as encoded
from tests.llm.test_decontaminate import brute as like
from tests.llm.test_minhash import brute as components
from tests.llm.test_quality_rules import brute as counted

ROOT = Path(__file__).resolve().parents[2]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = settled(stages[0](spark, docs, data), "t")
    decided = rows(quality_rules.quality(docs, "doc_id", "text", "lang"))
    assert good.columns == names and set(rows(good)) == {k for k, r in decided.items() if r["kept"]}
    assert all(r["base_failed"] == counted(t["text"])[-1] for (k, r), t in zip(sorted(decided.items()), [x for _, x in sorted(rows(docs).items())]))

    known = settled(stages[1](spark, good, data), "t")
    decided = rows(language.identify(good, "doc_id", "text", "lang", "source"))
    assert known.columns == names and set(rows(known)) == {k for k, r in decided.items() if r["kept"]}

    distinct = settled(stages[2](spark, known, data), "t")
    groups = components([(k, r["text"]) for k, r in rows(known).items()])
    assert distinct.columns == names and set(rows(distinct)) == {k for k, (_, _, kept) in groups.items() if kept}

    clean = settled(stages[3](spark, distinct, data), "t")
    items = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert clean.columns == names
    assert set(rows(clean)) == {k for k, r in rows(distinct).items() if max(like(r["text"], t) for t in items) < 0.75}

    out = {k: tuple(r)[1:] for k, r in rows(stages[4](spark, clean, data)).items()}
    assert out == {k: encoded(r["text"]) for k, r in rows(clean).items()}
    assert {k: tuple(r)[1:] for k, r in rows(corpus_pipeline.run(spark, data)).items()} == out


def test_empty_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, data), "t")
        assert docs.count() == 0


def test_repeated_ids(spark, data):
    """Rows that share an id and differ in text pass the filters each by itself."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    good = settled(corpus_pipeline.good(spark, docs, data), "t")
    known = settled(corpus_pipeline.known_language(spark, good, data), "t")
    whole = corpus_pipeline.distinct(spark, known, data).count()
    paired = good.withColumn("doc_id", F.expr("doc_id div 2")).unionByName(docs.limit(1).withColumns({"doc_id": F.lit(0).cast("long"), "text": F.lit("1 2 3")}))
    left = settled(corpus_pipeline.known_language(spark, paired, data), "t")
    out = corpus_pipeline.distinct(spark, left, data).collect()
    assert len(out) == whole
    assert "1 2 3" not in {r["text"] for r in out}


def test_entry_without_the_subpackage(tmp_path):
    """The entry imports, with the other queries only, where the subpackage and the pipeline are missing."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    for name in ("suite", "tablesync"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import re, __spark_entry__ as e; print(sorted(n for n in e.queries() if re.match('op[0-9]|pipeline', n)), len(e.queries()) > 100)"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.stdout.strip() == "[] True", said.stderr
