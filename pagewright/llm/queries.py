"""The registered queries of this subpackage, and the SQL that some are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, exact_dedup, filter_audit, language_model, mixing, near_dedup, packing, personal_data, preferences, quality_classifier, quality_rules, sharding, substring_dedup
from .common import stripped, text_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preferences.preference_pairs(preferences.swapped_answers(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(F.col("pair").alias("conv_id"), "prefix_turns", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"), "rejected", spans("rejected_mask").alias("rejected_mask"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.sha2(F.encode(personal_data.digest(F.col("base")), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in personal_data.KINDS], base, personal_data.digest(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = quality_rules.ledger(docs)
    m = lambda name: F.col(f"measured.{name}")
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.mask_of(quality_rules.POLICIES["v1"]))) != 0
    return kept.select("doc_id", m("words.n_words").alias("n_words"), m("word_chars").alias("word_chars"), m("n_symbols").alias("n_symbols"), m("n_dup_lines").alias("n_dup_lines"), m("words.n_repeat_words").alias("n_repeat_words"), base.alias("base_failed"), (~base & quality_rules.passes("v2")).alias("kept"), F.col("failed").alias("failed_bits"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("row_number")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = text_of(docs)
    carry = {"doc_id": docs["doc_id"], "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(F.encode(text, "UTF-8"))}
    found = sharding.shard_documents(docs, F.md5(F.encode(text, "UTF-8")), carry=carry)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")), copies="copies")
    digest = F.sha2(F.encode(conversation_repair.transcript(F.col("repaired")), "UTF-8"), 256)
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest.alias("repaired_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_model, op2_preferences, op3_personal_data, op4_exact_dedup, op5_packing, op6_mixing, op7_quality_rules, op8_quality_classifier, op9_near_dedup, op10_sharding, op11_conversation_repair, op12_filter_audit, op13_substring_dedup)
}

WHITE = "[\\x20\\x09-\\x0D]"


def repair_sql() -> str:
    """The cheapest edits as a recursion over rows from the last to the first, with the least (cost, audit, lines) of each state."""
    then, role = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    kept = {0: "CASE ini WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE never END", 1: "CASE ini WHEN 'u' THEN v2 ELSE never END", 2: "CASE ini WHEN 'a' THEN v3 ELSE never END", 3: "CASE ini WHEN 'u' THEN v2 ELSE never END"}
    edit = lambda before, cost, name, lines: f"{{'c': ({before}).c + {cost}, 'a': '{name}' || ({before}).a, 't': {lines} || ({before}).t}}"
    stay = "CASE WHEN fault IN ('b', 'd') THEN 1000000 WHEN fault = 't' THEN {0} + 1 ELSE {0} END"
    used = lambda s: "list_sort([" + ", ".join((edit(f"v{s}", 3, "D", "[]::VARCHAR[]"), edit(f"v{then[s]}", stay.format(2), "R", f"['{role[then[s]]}:' || text]"), edit(kept[s], stay.format(0), "K", "[role || ':' || text]"))) + f"])[1] AS g{s}"
    def added(s: int) -> str:
        a, b = then[s], then[then[s]]
        return f"list_sort([g{s}, {edit(f'g{a}', 2, 'I', f"['{role[a]}:']")}, {edit(f'g{b}', 4, 'II', f"['{role[a]}:', '{role[b]}:']")}])[1] AS v{s}"
    done, never = "{'c': 0, 'a': '', 't': []::VARCHAR[]}", "{'c': 1000000, 'a': '', 't': []::VARCHAR[]}"
    states = range(4)
    return f"""
        WITH RECURSIVE
             k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, [ascii(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS bytes FROM conversations),
             c AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS code FROM k),
             e AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c),
             f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen, left(role, 1) AS ini FROM e),
             g AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN seen THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM f),
             s AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
             a AS (SELECT o.conv_id, coalesce(s.n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN s ON o.conv_id IS NOT DISTINCT FROM s.conv_id),
             r AS (
                 SELECT conv_id, n + 1 AS i, {", ".join(added(s) for s in states)} FROM (SELECT conv_id, n, {done} AS g0, {never} AS g1, {never} AS g2, {done} AS g3 FROM a)
                 UNION ALL
                 SELECT conv_id, i, {", ".join(added(s) for s in states)} FROM (SELECT r.conv_id, g.i, {", ".join(used(s) for s in states)} FROM (SELECT *, {never} AS never FROM r) r JOIN g ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i = r.i - 1))
        SELECT a.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, (r.v0).c::BIGINT AS cost, (r.v0).a AS audit, sha256(array_to_string((r.v0).t, chr(10))) AS repaired_sha256
        FROM a JOIN r ON a.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = 1
    """


ORACLES: dict[str, str] = {
    "op2_preferences": """
        WITH l AS (SELECT conv_id, max(turn) AS e FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
             a AS (SELECT c.conv_id, c.turn AS e, c.text FROM conversations c JOIN l ON c.conv_id = l.conv_id AND c.turn = l.e AND c.role = 'assistant'),
             p AS (SELECT a.conv_id, a.e, a.text AS good, b.text AS bad FROM a JOIN a b ON b.conv_id = xor(a.conv_id, 1)),
             t AS (SELECT p.conv_id, p.e, p.good, p.bad, c.turn, c.role, '<|' || c.role || '|>' || chr(10) || c.text || chr(10) || '<|end|>' || chr(10) AS shown FROM conversations c JOIN p ON c.conv_id = p.conv_id AND c.turn <= p.e),
             g AS (SELECT conv_id, any_value(good) AS good, any_value(bad) AS bad, count(*) AS n, string_agg(shown, '' ORDER BY turn) FILTER (turn < e) AS head FROM t GROUP BY conv_id),
             s AS (SELECT conv_id, good = bad AS same, n, coalesce(head, '') AS head, '<|assistant|>' || chr(10) || good || chr(10) || '<|end|>' || chr(10) AS g, '<|assistant|>' || chr(10) || bad || chr(10) || '<|end|>' || chr(10) AS b FROM g)
        SELECT conv_id, CASE WHEN same THEN n ELSE n - 1 END AS prefix_turns, CASE WHEN same THEN head || g ELSE head END AS prompt,
               CASE WHEN same THEN '' ELSE g END AS chosen, CASE WHEN same THEN '' ELSE '14:' || length(g) END AS chosen_mask,
               CASE WHEN same THEN '' ELSE b END AS rejected, CASE WHEN same THEN '' ELSE '14:' || length(b) END AS rejected_mask
        FROM s
    """,
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{WHITE}+', '', 'g')) AS h FROM documents),
             g AS (SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
    """,
    "op6_mixing": """
        WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
             s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
             w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
             r AS (SELECT *, sum(source_size::DOUBLE) OVER () * 1.5 AS whole, sum(weight) OVER () AS all_weight,
                     coalesce(sum(source_size::DOUBLE) OVER b * 2, 0.0) AS spent, coalesce(sum(weight) OVER b, 0.0) AS spent_weight
                   FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
             c AS (SELECT *, (whole - spent) * weight >= source_size::DOUBLE * 2 * (all_weight - spent_weight) AS stopped FROM r),
             t AS (SELECT source, source_size, CASE WHEN stopped THEN source_size::DOUBLE * 2 ELSE
                     (whole - coalesce(sum(CASE WHEN stopped THEN source_size::DOUBLE END) OVER () * 2, 0.0)) * weight / sum(CASE WHEN NOT stopped THEN weight END) OVER () END AS target FROM c),
             u AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest), 1, 8))::BIGINT / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
    """,
    "op7_quality_rules": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
             w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
             g AS (SELECT r, i, words[i:i + 4] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
             p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
             c AS (SELECT r, count(DISTINCT i + k) AS n FROM p, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
             m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '{WHITE}+', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                          len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
                          length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS caps, length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS letters FROM w LEFT JOIN c ON w.r = c.r),
             b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END) AS base,
                          (CASE WHEN n_words >= 10 AND 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
                          + (CASE WHEN n_words >= 50 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 16 ELSE 0 END) + (CASE WHEN n_words >= 10 AND 100 * caps > 60 * letters THEN 32 ELSE 0 END) AS more FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base > 0 AS base_failed, base + more = 0 AS kept, (base + more)::BIGINT AS failed_bits FROM b
    """,
    "op11_conversation_repair": repair_sql(),
    "op12_filter_audit": """
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
             w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
             l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
             f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > least, false)] AS bad
                   FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
             x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
             o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
             p AS (SELECT part, good, toxic, bad, o, coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda k: bad[strpos('ABCDE', o[k:k])])), 6) AS first FROM f, o),
             s AS (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM p),
             c AS (SELECT part, o AS filter_order, step, count(*) FILTER (first > step) AS kept, count(*) FILTER (first = step) AS removed,
                     count(*) FILTER (first < step AND bad[strpos('ABCDE', o[step:step])]) AS redundant,
                     count(*) FILTER (bad[strpos('ABCDE', o[step:step])] AND len(list_filter(bad, lambda b: b)) = 1) AS unique_fails,
                     count(*) FILTER (first = step AND good) AS good_lost, count(*) FILTER (first = step AND toxic) AS toxic_lost FROM s GROUP BY part, o, step)
        SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step:step]))::BIGINT AS shapley FROM c
    """,
    "op13_substring_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             g AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
             m AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE least < doc_id),
             c AS (SELECT DISTINCT r, i + k AS i FROM m, (SELECT unnest(range(0, 13)) AS k)),
             k AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
             l AS (SELECT k.r, string_agg(word, ' ' ORDER BY k.i) FILTER (c.i IS NULL) AS left_over, count(c.i) AS gone FROM k LEFT JOIN c ON k.r = c.r AND k.i = c.i GROUP BY k.r)
        SELECT doc_id, len(w) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256 FROM d LEFT JOIN l ON d.r = l.r
    """,
}
