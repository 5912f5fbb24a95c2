"""Language of a text from its scripts and its stop words, and the rules over windows of it.

Stop words are a dimension of fixed size: words are exploded, joined with it by
broadcast, and summed per text before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The stop words by language.
STOP_WORDS: dict[str, str] = {
    "en": "a about after also an and are as at be been between by can for from has have in into is it may not of on or our that the their these this to using was were which with",
    "ru": "без более был была были быть в во для до его ее если из или к как между на не но о об от по после при с со так также то у что это",
    "de": "aber als auch auf bei dem den der des deutschen diagnostik die diese dieser durch eine einem einen einer für haben ist mit nach nicht oder patienten sich sind sowie und untersuchung von werden wurde zur",
    "fr": "analyse aux avec ces cette chez comme dans des du elle entre est et les leur mais méthode nous par pas peut plus pour que qui résultats sont sur une étude être",
    "es": "análisis como con del desde dos el en entre es esta este estos estudio las los método más para pero por que resultados se sin son sus también una uno",
    "it": "analisi che con dei del della delle gli il in la le lo ma metodo nel nella per più questo risultati sono studio sulla tra uno",
    "pt": "análise com como das dos em entre esta este estudo foi mais mas método não os para por que resultados se sem são uma",
    "nl": "als analyse bij dat de der dit door een en het hun in is met methode niet om onderzoek op resultaten te van voor werden zijn",
    "pl": "ale analiza badania bez dla do jako jest które lub metoda na nie oraz po przez się są także tego to wyniki z ze",
}
#: Order in which equal counts are settled.
EUROPEAN = ("de", "fr", "es", "it", "pt", "nl", "pl")

# Character ranges of the scripts.
LATIN = r"[A-Za-zÀ-ÖØ-öø-ÿ]"
CYRILLIC = r"[Ѐ-ӿ]"
CJK = r"[぀-ヿ㐀-䶿一-鿿豈-﫿]"
KANA = r"[぀-ヿ]"
HAN = r"[㐀-䶿一-鿿豈-﫿]"
WORD = r"[A-Za-zÀ-ÖØ-öø-ÿЀ-ӿ]+"

WINDOW_CHARS, MOST_WINDOWS = 4500, 9

# The cascade. The first rule that holds gives (language, reason, confidence); SQL over the measures.
RULES: tuple[tuple[str, str, str, str], ...] = (
    ("cjk >= min_alpha AND kana >= 20", "'ja'", "'japanese_kana_cjk'", "0.96D"),
    ("han >= min_alpha AND kana < 20", "'zh'", "'chinese_han_majority'", "0.94D"),
    ("alpha + cjk < min_alpha OR n_words < min_words", "'unknown'", "'too_little_text'", "0.0D"),
    ("cyrillic >= 200 AND cyrillic_ratio >= 0.35D", "'ru'", "'cyrillic_majority'", "greatest(0.86D, least(0.99D, ru_score))"),
    ("cyrillic >= 120 AND cyrillic_ratio >= 0.15D AND ru_hits >= 8", "'ru'", "'russian_stopwords'", "greatest(0.8D, least(0.98D, ru_score))"),
    ("latin_ratio >= 0.72D AND eu_hits >= 12 AND eu_hits >= greatest(12, floor(en_hits * 0.75D))", "eu", "concat('latin_majority_', eu, '_stopwords')", "greatest(0.78D, least(0.98D, eu_score))"),
    ("latin_ratio >= 0.72D AND en_hits >= 12 AND cyrillic_ratio < 0.12D", "'en'", "'latin_majority_english_stopwords'", "greatest(0.78D, least(0.99D, en_score))"),
    ("latin_ratio >= 0.35D AND cyrillic_ratio >= 0.20D", "'mixed'", "'substantial_latin_and_cyrillic'", "least(0.92D, greatest(latin_ratio, cyrillic_ratio))"),
    ("en_score > ru_score AND en_score >= 0.65D", "'en'", "'english_score'", "least(0.9D, en_score)"),
    ("ru_score > en_score AND ru_score >= 0.65D", "'ru'", "'russian_score'", "least(0.9D, ru_score)"),
    ("true", "'unknown'", "'low_confidence'", "greatest(en_score, ru_score)"),
)

# Scores from ratios and stop word counts.
SCORES = {
    "en_score": "latin_ratio * 0.72D + least(en_hits / 35.0D, 1.0D) * 0.28D",
    "ru_score": "cyrillic_ratio * 0.78D + least(ru_hits / 25.0D, 1.0D) * 0.22D",
    "eu_score": "latin_ratio * 0.70D + least(eu_hits / 35.0D, 1.0D) * 0.30D",
}


def case(part: int) -> str:
    return "CASE " + " ".join(f"WHEN {r[0]} THEN {r[part]}" for r in RULES) + " END"


def stop_words(spark: SparkSession) -> DataFrame:
    """(word, code): fixed values, about 260 rows."""
    return spark.createDataFrame([(w, code) for code, words in STOP_WORDS.items() for w in words.split()], "word string, code string")


def detect(df: DataFrame, keys: list[str], text: Column, min_alpha: int, min_words: int) -> DataFrame:
    """One row per row of ``df``, whose ``keys`` are unique: keys, language, confidence, reason and the measures."""
    n = lambda pattern: F.regexp_count("text", F.lit(pattern))
    base = df.select(*keys, F.trim(F.regexp_replace(text, r"\s+", " ")).alias("text"))
    # one scan: words leave a row beside its measures, and meet again in a partial aggregate before they are shuffled
    measures = {"n_chars": F.char_length("text"), "n_words": n(WORD), "latin": n(LATIN), "cyrillic": n(CYRILLIC), "cjk": n(CJK), "kana": n(KANA), "han": n(HAN)}
    measured = base.select(*keys, *[m.alias(k) for k, m in measures.items()], F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    # the words are exploded in a step of their own: measures beside a generator would be made for each word
    met = measured.select(*keys, *measures, F.explode_outer("words").alias("word")).join(F.broadcast(stop_words(df.sparkSession)), "word", "left")
    joined = met.groupBy(*keys, *measures).agg(*[F.count_if(F.col("code") == c).alias(f"hits_{c}") for c in STOP_WORDS])
    best = F.greatest(*[F.struct(F.col(f"hits_{c}").alias("n"), F.lit(-i).alias("order"), F.lit(c).alias("code")) for i, c in enumerate(EUROPEAN)])
    alpha = F.col("latin") + F.col("cyrillic")
    ratio = lambda c: F.when(alpha > 0, F.col(c) / alpha).otherwise(F.lit(0.0))
    wide = joined.select("*", alpha.alias("alpha"), ratio("latin").alias("latin_ratio"), ratio("cyrillic").alias("cyrillic_ratio"), F.col("hits_en").alias("en_hits"), F.col("hits_ru").alias("ru_hits"), best["n"].alias("eu_hits"), best["code"].alias("eu"), F.lit(min_alpha).alias("min_alpha"), F.lit(min_words).alias("min_words"))
    wide = wide.select("*", *[F.expr(sql).alias(k) for k, sql in SCORES.items()])
    return wide.select(*keys, F.expr(case(1)).alias("language"), F.expr(case(3)).alias("confidence"), F.expr(case(2)).alias("reason"), "n_chars", F.col("n_words").cast("long").alias("n_words"), F.col("en_hits").cast("long").alias("en_hits"), F.col("ru_hits").cast("long").alias("ru_hits"), "latin_ratio", "cyrillic_ratio")


def windows(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, start, text): the whole text, or 3 to 9 evenly spread windows of it."""
    base = df.select(key, F.trim(F.regexp_replace(text, r"\s+", " ")).alias("text")).withColumn("n", F.char_length("text"))
    count = F.least(F.lit(MOST_WINDOWS), F.greatest(F.lit(3), F.floor(F.col("n") / WINDOW_CHARS) + 1))
    span = F.greatest(F.lit(1), F.col("n") - WINDOW_CHARS)
    starts = F.when(F.col("n") <= WINDOW_CHARS, F.array(F.lit(0).cast("long"))).otherwise(F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.bround(span * i / (count - 1)).cast("long")))))
    return base.select(key, "text", F.explode(starts).alias("start")).select(key, "start", F.substring("text", F.col("start").cast("int") + 1, F.lit(WINDOW_CHARS)).alias("text"))


def detect_document(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, language, confidence, reason, windows): the whole text's verdict, held against its windows."""
    whole = detect(df, [key], text, 250, 40)
    parts = detect(windows(df, key, text), [key, "start"], F.col("text"), 160, 24)
    sure = (F.col("language") != "unknown") & (F.col("confidence") >= 0.65)
    per = parts.groupBy(key, "language").agg(F.count_if(sure).alias("n"), F.min(F.when(sure, F.col("start"))).alias("first"), F.max(F.when(sure, F.col("confidence"))).alias("best"), F.count("*").alias("all"))
    votes = per.groupBy(key).agg(
        F.sum("all").alias("windows"),
        F.sum("n").alias("reliable"),
        F.count_if((F.col("n") > 0) & ~F.col("language").isin("unknown", "mixed")).alias("languages"),
        F.max("best").alias("best"),
        F.max(F.when(F.col("n") > 0, F.struct("n", (-F.col("first")).alias("order"), "language"))).alias("top"),
        F.map_from_entries(F.collect_list(F.struct("language", "n"))).alias("counts"),
    )
    w = whole.join(votes, key)
    own = lambda code: F.coalesce(F.element_at("counts", code), F.lit(0))
    mine = own(F.col("language"))
    ru = (F.col("language") == "ru") & (F.col("cyrillic_ratio") >= 0.65) & (F.col("ru_hits") >= F.greatest(F.lit(20), F.col("en_hits") * 2)) & (own(F.lit("ru")) >= 2) & (own(F.lit("ru")) > own(F.lit("en")))
    mixed = (F.col("languages") >= 2) & (mine < F.greatest(F.lit(2), F.col("reliable") - 1))
    swap = ((F.col("language") == "unknown") & (F.col("top.n") >= 2)) | ((F.col("top.language") != F.col("language")) & (F.col("top.n") >= 2) & (F.col("top.n") > mine))
    raised = lambda n: F.greatest(F.col("confidence"), F.least(F.lit(0.94), 0.68 + n * 0.05))
    pick = lambda same, r, m, s: F.when(F.col("reliable") == 0, same).when(ru, r).when(mixed, m).when(swap, s).otherwise(same)
    return w.select(
        key,
        pick(F.col("language"), F.lit("ru"), F.lit("mixed"), F.col("top.language")).alias("language"),
        pick(F.col("confidence"), raised(own(F.lit("ru"))), F.least(F.lit(0.95), F.col("best")), raised(F.col("top.n"))).alias("confidence"),
        pick(F.col("reason"), F.lit("document_dominant_russian"), F.lit("document_windows_disagree"), F.concat(F.lit("document_window_majority_"), F.col("top.language"))).alias("reason"),
        F.col("windows").cast("long").alias("windows"),
    )


def gate(language: Column, confidence: Column, target: str = "en", least: float = 0.75, skip_unknown: bool = False) -> Column:
    """(skip, reason): whether a document's language rules it out."""
    verdict = lambda skip, reason: F.struct(F.lit(skip).alias("skip"), reason.alias("reason"))
    unknown = verdict(True, F.lit("unknown_language_requested_skip")) if skip_unknown else verdict(False, F.lit("unknown_language_allowed"))
    if target in ("", "auto", "any", "all"):
        return verdict(False, F.lit("no_target_language"))
    return (
        F.when(language == target, verdict(False, F.lit("target_language_detected")))
        .when(language == "unknown", unknown)
        .when(confidence >= least, verdict(True, F.concat(F.lit("detected_"), language, F.lit(f"_not_{target}"))))
        .otherwise(verdict(False, F.lit("non_target_below_threshold")))
    )




#: Other names of languages by their codes.
LANGUAGE_NAMES = {
    "en": "english eng en-us en-gb",
    "ru": "russian rus ru-ru",
    "de": "german deu ger de-de",
    "fr": "french fra fre fr-fr",
    "es": "spanish spa es-es",
    "it": "italian ita it-it",
    "pt": "portuguese por pt-br pt-pt",
    "nl": "dutch nld dut nl-nl",
    "pl": "polish pol pl-pl",
    "ja": "japanese jpn ja-jp",
    "zh": "chinese zho chi zh-cn zh-tw",
}


def normalized_code(value: Column) -> Column:
    """A language's code from its name; a name that isn't known stays, in lower case. Null is empty."""
    plain = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    names = F.create_map(*[F.lit(x) for code, names in LANGUAGE_NAMES.items() for name in names.split() for x in (name, code)])
    return F.coalesce(names[plain], plain)


def requested_polish_language(value: Column) -> Column:
    """en, ru, other or auto; English if nothing is asked for."""
    asked = F.lower(F.trim(F.when(value != "", value).otherwise("en")))
    code = normalized_code(asked)
    return F.when(asked == "auto", "auto").when(code.startswith("ru"), "ru").when(code.startswith("en"), "en").otherwise("other")


def selected_polish_language(requested: Column, detected: Column, confidence: Column, least: float = 0.75) -> Column:
    """The rules that a document gets: those asked for, or, for auto, those of the language that was found, if that is sure enough."""
    code = normalized_code(detected)
    found = F.when(code.isin("en", "ru"), code).when(code != "unknown", "other").otherwise("en")
    return F.when(requested != "auto", requested).when(confidence >= least, found).otherwise("en")
