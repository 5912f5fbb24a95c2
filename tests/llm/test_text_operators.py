import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import personal_data, quality_rules

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_by_hand(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(personal_data.KINDS[k], s, e) for s, k, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.b-1025+ (\n)é%", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert personal_data.base_spans(text) == base_by_hand(text)


def test_base_spans_on_documents(docs):
    for r in docs.collect():
        assert personal_data.base_spans(r["text"]) == base_by_hand(r["text"])


def test_base_spans_take_linear_time():
    personal_data.base_spans("a" * 300_000 + "@" + "1" * 300_000 + "@a" * 1000 + "+1" + "(" * 100_000)


def test_find_on_odd_rows(odd, none):
    got = {r["doc_id"]: r for r in personal_data.find(odd, redacted=True).collect() if r["doc_id"] is not None}
    assert len(got[5]["base"]) == 6 and got[5]["redacted"].startswith("Mail <EMAIL> or <PHONE>.")
    assert [x["kind"] for x in got[8]["base"]] == ["ip", "card"]
    assert personal_data.find(odd).count() == odd.count()
    assert personal_data.find(none).count() == 0


def test_a_linked_mention_is_added():
    table = [("node", personal_data.features("a.b@c.de"), 1, 50), ("node", personal_data.features("2024"), 0, 200), ("skip", 1, 1, 40), ("skip", 4, 4, 40), ("skip", 0, 0, 40)]
    field = personal_data.fit(table)
    text = "write to jane.doe@mail.example.com today, jane.doe answers, since 2024"
    base = personal_data.base_spans(text)
    added = personal_data.added_spans(text, base, field, 0.9)
    assert [text[s:e] for _, s, e in added] == ["jane.doe"] and added[0][0] == "email"
    assert personal_data.added_spans("2024 and 2024 again", [], field, 0.9) == []


def test_the_field_runs_without_base_spans_and_counts_all(spark):
    rows = [(i, f"write to jane{i}.doe@mail.example.com today or jane{i}.doe@mail.example.com later, seen in 2024") for i in range(60)]
    rows.append((99, "ask jane7.doe@mail..com today and jane7.doe@mail..com again"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    (got,) = personal_data.find(df).where("doc_id = 99").collect()
    assert got["base"] == [] and [x["kind"] for x in got["added"]] == ["email", "email"]
    table = personal_data.gather(df.selectExpr("doc_id AS id", "text"))
    assert sum(n for what, _, y, n in table if what == "node" and y == 1) == 120


def rules_by_hand(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def rules_held(df):
    got = quality_rules.ledger(df.select("doc_id", "text")).collect()
    for r in got:
        m = r["measured"]
        assert (m["words"]["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["words"]["n_repeat_words"]) == rules_by_hand(r["text"]), r["doc_id"]
    return got


def test_rules_on_odd_rows(odd, none):
    rules_held(odd)
    assert quality_rules.ledger(odd).columns == [*odd.columns, "measured", "failed"]
    assert quality_rules.ledger(none).count() == 0


def test_rules_on_documents_and_ablations(docs):
    got = rules_held(docs)
    mask = quality_rules.mask_of(quality_rules.POLICIES["v2"])
    for r in quality_rules.ablations(quality_rules.ledger(docs), "v2").collect():
        bit = 1 << quality_rules.RULES[r["rule"]]
        assert r["fails"] == sum(bool(g["failed"] & bit) for g in got)
        assert r["fails_only_this"] == sum(g["failed"] & mask == bit for g in got)
