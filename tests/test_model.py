"""Random documents: the engine against the plain-Python reading, document by document."""

import random
from collections import Counter

import pytest

from tests.golden import AS_OF
from tests.model import decide, random_document
from tradeline import decide_documents, parse_requests, score_requests


@pytest.mark.parametrize("seed", [1, 2])
def test_random_documents(spark, seed):
    rng = random.Random(seed)
    texts = {str(i): random_document(rng) for i in range(3000)}
    raw = spark.createDataFrame(list(texts.items()), "request_id string, value string").repartition(8)
    if seed == 1:
        out = decide_documents(raw, AS_OF)
    else:
        out = score_requests(parse_requests(raw), AS_OF)
    rows = out.select(
        "request_id", "accept_ind", "bureau_history_status", "bnpl_limit", "error_reason"
    ).collect()
    assert len(rows) == len(texts)
    seen = Counter()
    for r in rows:
        want = decide(texts[r.request_id])
        got = (r.accept_ind, r.bureau_history_status, r.bnpl_limit, r.error_reason)
        assert got == want, texts[r.request_id]
        seen[want[0], want[1], want[3]] += 1
    assert len(seen) >= 15, seen
