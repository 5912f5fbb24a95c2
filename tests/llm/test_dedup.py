import re
from collections import defaultdict

from pyspark.sql import functions as F

from pagewright.llm import exact_dedup, near_dedup


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    out = {}
    for members in groups.values():
        best = min(members[:], key=lambda m: m[:3])
        for m in members:
            out[m[3]] = (None if best[1] else best[2], len(members))
    return out


def held(docs, **options):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = exact_dedup.exact_dedup(docs, **options).collect()
    want = exact_by_hand(rows)
    key = lambda v: tuple((x is None, x) for x in v)
    assert sorted(((g["doc_id"], g["keep_id"], g["group_size"]) for g in got), key=key) == sorted(((rows[i][0], *w) for i, w in want.items()), key=key)
    assert sum(g["kept"] for g in got) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    return got


def test_exact_on_odd_rows(odd):
    held(odd)


def test_exact_in_micro_batches_with_a_weak_digest(docs):
    weak = lambda text: F.substring(exact_dedup.sha256(text), 1, 1)
    held(docs.repartition(7), digest=weak, max_files=2)


def test_exact_when_digests_are_too_many_to_broadcast(docs):
    held(docs, broadcast_rows=0)


def test_exact_on_an_empty_table(none):
    assert exact_dedup.exact_dedup(none).count() == 0


def near_by_hand(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[top(i)].append(rows[i][0])
    least = {k: min(v, key=lambda x: (x is None, x)) for k, v in classes.items()}
    return [(rows[i][0], least[top(i)], len(classes[top(i)])) for i in range(len(rows))]


def near_held(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = near_dedup.near_duplicates(df, **options).collect()
    key = lambda v: tuple((x is None, x) for x in v)
    want = near_by_hand(rows)
    assert sorted(((g["doc_id"], g["class_id"], g["class_size"]) for g in got), key=key) == sorted(want, key=key)
    return got


def test_near_on_odd_rows(odd):
    got = near_held(odd)
    assert near_dedup.kept_documents(odd).count() == sum(g["kept"] for g in got)
    assert near_dedup.kept_documents(odd).columns == odd.columns


def test_near_on_documents(docs):
    near_held(docs)


def test_near_without_broadcast(docs):
    near_held(docs, broadcast_rows=0)


def test_near_finds_the_hub_of_copies_that_are_far_from_each_other(spark):
    import random

    rng = random.Random(5)
    hub = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(hub))]
    for i in range(1, 25):
        own = list(hub)
        for at in rng.sample(range(400), 7):
            own[at] = f"v{i}-{at}"
        rows.append((i, " ".join(own)))
    near_held(spark.createDataFrame(rows, "doc_id long, text string"))


def test_near_on_an_empty_table(none):
    assert near_dedup.near_duplicates(none).count() == 0


def test_darts_estimate_weighted_jaccard():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 300).astype(np.uint64)
    w, v = rng.random(300) * 3 + 0.1, rng.random(300) * 3 + 0.1
    a, b = near_dedup.dart_min_hash([x, x], 2000, [w, v])
    want = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    assert abs((a == b).mean() - want) < 0.04
