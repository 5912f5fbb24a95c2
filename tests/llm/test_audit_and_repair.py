"""Operators 11 to 13 against brute force, and on odd tables."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest

from pagewright.llm import conversation_repair, filter_audit, queries, substring_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CONV = "conv_id long, turn long, role string, text string"


def cheapest(signature):
    """Cost and audit by uniform-cost search over (rows used, result so far)."""
    queue = [(0, "", 0, "")]
    seen = set()
    while queue:
        cost, audit, i, roles = heapq.heappop(queue)
        if i == len(signature) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit
        if not re.fullmatch(r"s?(ua)*u?", roles) or (i, roles, audit) in seen:  # nothing can follow, or it was here before
            continue
        seen.add((i, roles, audit))
        if audit[-4:] != "IIII":
            for r in "ua":
                heapq.heappush(queue, (cost + 2, audit + "I", i, roles + r))
        if i < len(signature):
            x = signature[i]
            more = x.isupper()
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, roles))
            if x != "x":
                heapq.heappush(queue, (cost + more, audit + "K", i + 1, roles + x.lower()))
                for r in "ua":
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, roles + r))
    return None


def test_audits_against_search():
    for n in range(4):
        for signature in map("".join, itertools.product("suaoUAx", repeat=n)):
            cost, audit, plan = conversation_repair.solve(signature)
            assert (cost, audit) == cheapest(signature), signature
            roles = "".join((role or signature[i].lower())[:1] for i, role in plan)
            assert re.fullmatch(r"(s?(ua)+)?", roles)


def test_a_long_signature_is_solved():
    cost, audit, plan = conversation_repair.solve("ua" * 20_000 + "u")
    assert cost == 2 and audit == "K" * 40_001 + "I" and plan[-1] == (-1, "assistant")


def test_repair_of_odd_conversations(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (2, 5, "system", "Be brief."), (None, None, None, None), (None, 3, "tool", "x\n" * 20_000 + "y."), (3, 2, "user", "no end"), (3, 9, "assistant", "fine!")]
    conv = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS seen", "'x' AS signature", "2 AS row")
    got = {r["conv_id"]: r for r in conversation_repair.repair(conv).collect()}
    assert got[1]["audit"] == "KKD" and got[1]["duplicate"] == 1 and got[1]["illegal"] == 1 and got[1]["gaps"] == 0
    assert got[2]["audit"] == "D" and got[2]["repaired"] == []
    assert got[None]["blank"] == 1 and got[None]["gaps"] == 0 and got[None]["audit"] == "DD"
    assert got[3]["gaps"] == 6 and got[3]["cost"] == 1 and [tuple(t) for t in got[3]["repaired"]] == [("user", "no end"), ("assistant", "fine!")]
    empty = conversation_repair.repair(conversation_repair.damage(spark.createDataFrame([], CONV)), copies="copies")
    assert empty.count() == 0
    dropped = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = conversation_repair.repair(conversation_repair.damage(spark.createDataFrame([(dropped, 0, "user", "Hi.")], CONV)), copies="copies").first()
    assert one["audit"] == "" and one["cost"] == 0 and one["repaired"] == []


def test_repair_by_shuffle_gives_the_same(spark):
    conv = conversation_repair.damage(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(conversation_repair.repair(conv, "copies", broadcast_rows=0)) == key(conversation_repair.repair(conv, "copies"))


def test_audit_counts_by_hand(spark):
    rows = [(1, "a " * 250, None), (2, "a " * 250, ""), (3, None, "s"), (None, "a " * 250, "s"), (4, "Word %" * 3, "s"), (4, "Word %" * 3, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "7 AS failed", "'x' AS part", "1 AS step")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 0, None), (4, None, 1)], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(docs, labels).collect()}
    assert len(got) == 2 * 600
    first = got["", "EBACD", 1]
    assert (first["removed"], first["kept"], first["good_lost"], first["toxic_lost"]) == (1, 1, 1, 1)
    assert got["", "BEACD", 2]["redundant"] == 1 and got["", "BEACD", 1]["unique_fails"] == 1
    assert got["s", "ABCDE", 1]["removed"] == 3 and got["s", "ABCDE", 1]["toxic_lost"] == 2 and got["s", "ABCDE", 5]["removed"] == 0
    assert sum(r["removed"] for k, r in got.items() if k[0] == "s" and k[1][k[2] - 1] == "D") == got["s", "DABCE", 1]["shapley"]
    assert filter_audit.audit(docs.where("false"), labels).count() == 0


def test_audit_against_sql_with_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    con.register("documents", odd.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", labels.toPandas())
    want = con.execute(queries.ORACLES["op12_filter_audit"]).df()
    got = filter_audit.audit(odd, labels).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


def covered(docs, size=13):
    """Per document, whether each word is in a window that starts in a document with a smaller id."""
    words = [WORDS.findall(t or "") for _, t in docs]
    least = {}
    for (i, _), w in zip(docs, words):
        for s in range(len(w) - size + 1):
            if i is not None:
                k = tuple(w[s : s + size])
                least[k] = min(least.get(k, i), i)
    out = []
    for (i, _), w in zip(docs, words):
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if i is not None and least[tuple(w[s : s + size])] < i:
                gone[s : s + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def cut(docs, **more):
    return sorted(map(tuple, substring_dedup.cut_repeats(docs, **more).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_cuts_against_brute_force(spark, seed):
    """Few words and many shared passages, so that leaders, second seeds and repeats within a text all occur."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3 if seed == 2 else 30)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(5, 400))] for _ in range(12)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(r.randint(0, 5)):
            p = list(r.choice(passages))
            if r.random() < 0.5:
                p[r.randrange(len(p))] = "new"
            w += p[r.randrange(len(p)) :] if r.random() < 0.3 else p
            w += [r.choice(vocabulary) for _ in range(r.randint(0, 4))]
        rows.append((r.choice([None, i // 2, i, i]), " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert cut(docs) == covered(rows)
    if not seed:
        assert cut(docs, broadcast_rows=0) == covered(rows)


def test_cuts_of_odd_tables(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert cut(odd) == covered(rows)
    assert cut(none) == []
    assert cut(odd.where("doc_id = 4")) == covered([r for r in rows if r[0] == 4])
    texts = [(1, "a b " * 9_000), (2, "b a " * 9_000), (3, "x" * 2_500_000 + " a b" * 20), (3, "a b " * 9_000)]
    got = cut(spark.createDataFrame(texts, "doc_id long, text string"))
    assert [r[:3] for r in got] == [(1, 18_000, 0), (2, 18_000, 18_000), (3, 18_000, 18_000), (3, 41, 40)]


def test_long_texts_are_hashed_in_pieces():
    text = ("word of some length " * 120_000).encode()
    assert (substring_dedup.hashes_of(text) == substring_dedup.word_hashes(text)).all()


def test_repeats_name_their_source(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = spark.createDataFrame([(7, f"one two {passage} three"), (9, f"{passage} four")], "doc_id long, text string")
    runs = [tuple(r) for r in substring_dedup.repeats(docs).select("doc_id", "start", "stop", "source").collect()]
    assert {s for d, a, b, _ in runs for s in range(a, b)} == set(range(38)) and {(d, s) for d, _, _, s in runs} == {(9, 7)}
    (_, n, removed, kept) = cut(docs, digests=True)[1]
    assert (n, removed, kept) == (51, 50, hashlib.sha256(b"four").hexdigest())
