"""The pipeline's stages, each on what its predecessor kept."""

import random

import pytest

import corpus_pipeline
from cohortlens.llm import decontaminate, minhash_tensor, mixing, queries, token_orc

ITEM = "seven copper kettles whistled while the northern ferry crossed a frozen harbour before the late winter market"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["".join(rng.choice("aeioubdfglmnprst") for _ in range(6)) for _ in range(2000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(k, text(rng.randrange(30, 120)), "en", f"src{k % 4}") for k in range(240)]
    rows += [(1000 + k, rows[k][1] + " tail", "en", "src1") for k in range(10)]  # near copies
    rows += [(2000 + k, f"{text(30)} {ITEM} {text(30)}", "en", "src2") for k in range(5)]
    rows += [(3000 + k, " ".join(t for w in text(40).split() for t in (w, *(["grumblefink"] if rng.random() < 0.2 else []))) + " grumblefink grumblefinks", "en", "src3") for k in range(120)]
    rows += [(4000, None, None, None), (4001, "", "en", None), (4002, "", "en", "src1")]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(240)] + [(3000 + k, 0, 1) for k in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, folder)
        if name != "token_output":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    toxic = [k for k in kept["toxicity"] if 3000 <= k < 4000]
    assert len(toxic) <= 6 and sum(k < 240 for k in kept["toxicity"]) >= 235
    assert not [k for k in kept["near_dedup"] if 1000 <= k < 1010 and k - 1000 in kept["toxicity"]]
    assert {4000, 4001, 4002} <= set(kept["near_dedup"])
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {k for k in range(2000, 2005)} & set(kept["toxicity"])
    assert set(kept["mixing"]) <= set(kept["decontamination"])
    plan = mixing.mix(spark.read.parquet(str(tmp_path / "decontamination")), mixing.words("text")).select("doc.doc_id", "copies")
    assert sorted(k for r in plan.collect() for k in [r["doc_id"]] * r["copies"]) == kept["mixing"]
    assert kept["token_output"] == kept["mixing"]
    want = token_orc.encode_and_reread(spark.read.parquet(str(tmp_path / "mixing")))
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, docs.collect()))


def test_empty_stages(spark, folder, tmp_path):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        assert step(spark, empty, folder).count() == 0


def test_queries_are_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {k.split("_")[0] for k in names if k.startswith("op")} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert minhash_tensor.SHARED == 75 and decontaminate.COVERED <= 0.8


def test_the_sketch_holds_a_number_per_cell():
    """One test vector at a time: memory does not hold RANK numbers for each cell of the matrix."""
    import tracemalloc

    import numpy as np

    rng, n, cells = np.random.default_rng(1), 500, 60_000
    passage, feature = np.sort(rng.integers(0, 9_000, cells)), rng.integers(0, n, cells)
    test = decontaminate._test_vectors(n)
    tracemalloc.start()
    frequency, gram = decontaminate.sketch(passage, feature, test)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts = np.zeros((9_000, n))
    np.add.at(counts, (passage, feature), 1)
    assert np.allclose(gram, counts.T @ (counts @ test)) and (frequency == (counts > 0).sum(0)).all()
    assert peak < cells * decontaminate.RANK * 8 / 2
