from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from tessera.llm import bpe, quality_model

from .conftest import SCHEMA, odd_rows, prose
from .test_jaccard_join import brute
from .test_mixing import brute_targets
from .test_quality_rules import brute as counts

tokenizers = pytest.importorskip("tokenizers")

NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


@pytest.fixture
def folder(spark, tmp_path):
    junk = [(200 + i, "same " * 50 + str(i), "en", "src1", 0) for i in range(5)] + [(300 + i, f"{prose(20, 5, i)} | # |" * 4, "en", "src2", 0) for i in range(5)]
    near = [(400 + i, prose(120, 11) + f" tail{i}", "fr", "src1", 0) for i in range(6)]
    clean = [(500 + i, prose(90, 2 * i + 5, i), "de", f"src{i % 2}", 0) for i in range(20)]
    rows = [*odd_rows(), *junk, *near, *clean]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int(not 200 <= r[0] < 400), 0) for r in [*junk, *clean, *near]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def docs_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def plain_tail(model, text: str) -> float:
    """The probability of the best grade: features one by one, weights added up."""
    words = text.split()
    total = 0.0
    for at, w in enumerate(words):
        total += sum(model.weights[i] for i in quality_model.features(w))
        if at and words[at - 1] == w:
            total += model.weights[zlib.crc32(quality_model.REPEATED_WORD.encode()) % quality_model.BUCKETS]
    lines = [x for x in text.split("\n") if x.strip()]
    again = round((len(lines) - len(set(lines))) * len(words) / len(lines))
    total += again * model.weights[zlib.crc32(quality_model.REPEATED_LINE.encode()) % quality_model.BUCKETS]
    return 1 / (1 + math.exp(model.thresholds[-1] - quality_model.SCALE * total / len(words)))


def test_stages_are_as_agreed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_works_on_all_that_its_predecessor_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe":
            assert out.columns == NAMES
        out.write.parquet(f"{tmp_path}/out-{name}")
        seen[name] = docs.collect(), spark.read.parquet(f"{tmp_path}/out-{name}").collect()
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
    before, after = seen["quality_rules"]
    failed = Counter(tuple(r) for r in before if counts(r.text)[5])
    assert failed and not {r.text for r in after if counts(r.text)[5]} and not Counter(map(tuple, after)) - Counter(map(tuple, before))
    assert {500 + i for i in range(20)} <= {r.doc_id for r in after} and not {r.doc_id for r in after} & set(range(200, 400))
    before, after = seen["quality_classifier"]
    model = quality_model.fit(docs_of(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if plain_tail(model, r.text) >= quality_model.SELECT_AT)
    assert {500 + i for i in range(20)} <= {r.doc_id for r in after}
    before, after = seen["near_duplicates"]
    groups = {c for _, n, c in brute([(r.doc_id, r.text) for r in before], 5, 80) if n}
    assert sorted(r.doc_id for r in after) == sorted(groups) and {400} <= groups and not groups & {401, 402, 403, 404, 405}
    before, after = seen["mixing"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(r.text.split())
    for r in after:
        taken[r.source] += len(r.text.split())
    most = max(len(r.text.split()) for r in before)
    assert all(abs(taken[s] - t) <= most for s, t in brute_targets(sizes).items())
    assert all(n <= 2 for n in Counter(map(tuple, after)).values()) and set(map(tuple, after)) <= set(map(tuple, before))
    before, after = seen["bpe"]
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    encoded = [(r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in before]
    digest = lambda ids: hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after) == Counter((d, len(ids), digest(ids)) for d, ids in encoded)
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, after))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert quality_model.train([]) is None
