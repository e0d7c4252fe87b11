"""The pipeline against a version in plain Python."""

import zlib

import numpy as np
import pandas as pd
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tallyline.llm import quality, secret_scan  # noqa: E402
from tallyline.llm.queries import tokenizer_path  # noqa: E402

from .test_corpus_operators import plain_components, plain_leaks  # noqa: E402


def test_pipeline(spark, small):
    from tokenizers import Tokenizer

    docs = pd.read_parquet(f"{small}/documents.parquet")
    forest = quality.fit(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    texts, source = {}, dict(zip(docs.doc_id, docs.source, strict=True))
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        counts, x = quality.statistics(text)
        if not quality.base_failed(counts[0], counts[4]) and forest.score(np.array([x]))[0] <= forest.threshold:
            texts[doc] = text
    same = plain_components(texts, 5)
    texts = {d: t for d, t in texts.items() if same[d][1] == d}
    items = pd.read_parquet(f"{small}/benchmark.parquet")
    hit = {d for d, _ in plain_leaks(texts, dict(zip(items.item_id, items.text, strict=True)))}
    texts = {d: t for d, t in texts.items() if d not in hit}
    spans, owners = {}, {}
    for d, t in texts.items():
        base = secret_scan.base_spans(t)
        spans[d] = [(s, e, v) for s, k, e, v in base + secret_scan.generic_spans(t, base) if k == "generic" or secret_scan._random_looking(v)]
        for *_, v in [*spans[d], *[(0, 0, b[3]) for b in base]]:
            owners.setdefault(v, set()).add(source[d])
    for d, t in texts.items():
        texts[d] = secret_scan.mask(t, [(s, e) for s, e, v in spans[d] if len(owners[v]) < secret_scan.EXAMPLE_OWNERS])
    t = Tokenizer.from_file(tokenizer_path())
    want = {}
    for d, text in texts.items():
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        for s in range(0, len(ids), 4096):
            want[d, s] = zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())
    got = {(r.doc_id, r.start): r.ids_crc32 for r in corpus_pipeline.run(spark, small).collect()}
    assert got == want
    assert len(want) < len(docs)
