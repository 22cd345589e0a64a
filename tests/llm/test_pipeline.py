"""The pipeline's stages: what goes, what stays, and whole results."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

from tests.llm.test_operators import brute_components, words


def test_stages_in_order(spark, tmp_path):
    random.seed(3)
    item = "zeta eta theta iota kappa lambda nu xi omicron rho sigma tau upsilon phi chi psi"
    clean = [words(n, 50) for n in range(60)]
    texts = [*clean, clean[0], clean[1] + " more", None, "123", f"{clean[2][:90]} {item} {words(99, 30)}", words(98, 40) + " a@b.cc"]
    rows = [(n, t, "en" if n % 2 else "fr", "s", len(t or "")) for n, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r.doc_id: r for r in pipeline.run(spark, str(tmp_path)).collect()}
    roots = [root for _, root in brute_components(texts, 5)]
    stays = [n for n in range(len(texts)) if roots[n] == n and n not in (62, 63, 64)]
    assert sorted(found) == stays
    tokenizer = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    for n in stays:
        text = texts[n].replace("a@b.cc", "[EMAIL]")
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found[n].ids, "<u4").tolist() == ids and found[n].n_tokens == len(ids)


def test_stage_columns(spark):
    assert [name for name, _ in pipeline.STAGES] == [
        "language ID", "near-duplicates", "decontamination", "personal data", "bpe"
    ]
