"""Quality rules: divergence of a document's distributions from its language's, in SQL functions only.

A language's references are counted over all its documents: the shares of character classes,
and the shares of its common words. A document's shares are held against them by the
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1), if the document and
the reference are long enough for shares to mean something.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import row_key, written

# ASCII white space, and what is not in a class of characters, as patterns.
SPACE, SPACES = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]+"
NO_SYMBOL = r"[^#*$%&|<>]+"
LOWER = "[a-z]+"
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "mark": r"\P{Punct}+"}
KINDS = ["lower", *CLASSES]
REPEAT = 8


def characters(text: Column, others: str) -> Column:
    """How many characters stay when all runs of `others` are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def word_list(text: Column) -> Column:
    """The words between ASCII white space; none if the text is null."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(inner) > 0, F.split(inner, SPACES)).otherwise(F.array().cast("array<string>"))


def repeated_words(rows: DataFrame, words: str) -> DataFrame:
    """`rows` with `n_repeat_words`: words inside windows of REPEAT words that the list holds twice or more.

    Windows are compared by 64-bit hashes within one text. Each step is a column of its own, so
    that nothing is computed again inside a lambda; texts whose windows are all distinct, as
    most are, skip the sort.
    """
    n = F.size("_h") - (REPEAT - 1)
    none = F.array().cast("array<bigint>")

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("_h", i + k) for k in range(REPEAT)])

    rows = rows.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_k", F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), window)).otherwise(none)).drop("_h")
    twice = F.size(F.array_distinct("_k")) < F.size("_k")
    places = F.transform("_k", lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    rows = rows.withColumn("_z", F.when(twice, F.sort_array(places))).drop("_k")

    def same(p: Column, i: Column) -> Column:
        before, after = F.get("_z", i - 1)["k"], F.get("_z", i + 1)["k"]
        return before.eqNullSafe(p["k"]) | after.eqNullSafe(p["k"])

    rows = rows.withColumn("_q", F.sort_array(F.transform(F.filter("_z", same), lambda p: p["i"]))).drop("_z")
    each = F.transform("_q", lambda x, i: F.least(F.lit(REPEAT), F.coalesce(F.get("_q", i + 1) - x, F.lit(REPEAT))))
    total = F.aggregate(each, F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0))).drop("_q")


def features(docs: DataFrame) -> DataFrame:
    """Counts of each row's whole text; the text itself is left behind."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    # Most characters are lower-case letters; the other classes are looked for in what is left without them.
    rest = F.regexp_replace(text, LOWER, "")
    rows = docs.select(
        "_id", "_row", "doc_id", "lang", F.length(text).alias("_n"), rest.alias("_t"), word_list(text).alias("_w"), lines.alias("_l")
    )
    rows = rows.select(
        "_id", "_row", "doc_id", "lang", "_w",
        F.size("_w").cast("long").alias("n_words"),
        (F.col("_n") - F.length("_t")).cast("long").alias("_lower"),
        characters(F.col("_t"), SPACES).alias("_spaceless"),
        characters(F.col("_t"), NO_SYMBOL).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        *[characters(F.col("_t"), others).alias(f"_{c}") for c, others in CLASSES.items()],
    )
    rows = rows.withColumn("word_chars", F.col("_lower") + F.col("_spaceless")).drop("_spaceless")
    return repeated_words(rows, "_w").drop("_w")


def divergence(pairs: Column) -> Column:
    """Jensen-Shannon divergence in bits of shares `p` and `q`, an array of structs of the two."""

    def term(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def both(x: Column) -> Column:
        m = (x["p"] + x["q"]) / 2
        return (term(x["p"], m) + term(x["q"], m)) / 2

    return F.aggregate(F.transform(pairs, both), F.lit(0.0), lambda s, x: s + x)


def class_distance(rows: DataFrame) -> DataFrame:
    """`rows` with `class_distance` and `_reference` (words of the language's documents)."""
    sums = rows.groupBy("lang").agg(
        F.sum("word_chars").alias("_chars"), F.sum("n_words").alias("_reference"), *[F.sum(f"_{c}").alias(f"_all_{c}") for c in KINDS]
    )
    joined = rows.join(written(sums), "lang")

    def share(prefix: str, total: str, c: str) -> Column:
        return F.col(f"{prefix}{c}") / F.col(total)

    pairs = [F.struct(share("_", "word_chars", c).alias("p"), share("_all_", "_chars", c).alias("q")) for c in KINDS]
    rest = [1 - sum(x[k] for x in pairs) for k in ("p", "q")]
    # Shares that add up to 1 can leave a little less than nothing.
    pairs.append(F.struct(F.greatest(rest[0], F.lit(0.0)).alias("p"), F.greatest(rest[1], F.lit(0.0)).alias("q")))
    distance = F.sqrt(F.greatest(divergence(F.array(*pairs)), F.lit(0.0)))
    return joined.withColumn("class_distance", F.when(F.col("word_chars") > 0, distance)).drop("_chars", *[f"_all_{c}" for c in KINDS])


def common_words(words: DataFrame, sizes: DataFrame, least_share: float) -> DataFrame:
    """`lang`, `word`, `q`: words that make up `least_share` of a language or more (so at most 1 / least_share of them)."""
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    return counts.join(sizes, "lang").where(F.col("n") >= least_share * F.col("total")).select("lang", "word", (F.col("n") / F.col("total")).alias("q"))


def word_distance(words: DataFrame, common: DataFrame) -> DataFrame:
    """`_id`, `_row`, `word_distance`: over the language's common words, all others being one."""
    rest = common.groupBy("lang").agg(F.sum("q").alias("known"))
    counted = words.join(common, ["lang", "word"], "left").groupBy("_id", "_row", "lang", F.when(F.col("q").isNotNull(), F.col("word")).alias("word"))
    counts = counted.agg(F.count("*").alias("n"), F.first("q").alias("q"))
    per_row = counts.groupBy("_id", "_row", "lang").agg(F.sum("n").alias("total"), F.collect_list(F.struct("n", "q")).alias("own"))
    per_row = per_row.join(written(rest), "lang", "left")
    named = F.filter("own", lambda x: x["q"].isNotNull())
    p, q = lambda x: x["n"] / F.col("total"), lambda x: x["q"]
    pairs = F.transform(named, lambda x: F.struct(p(x).alias("p"), q(x).alias("q")))
    p_rest = 1 - F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["p"])
    q_rest = 1 - F.coalesce("known", F.lit(0.0))
    other = F.struct(F.greatest(p_rest, F.lit(0.0)).alias("p"), F.greatest(q_rest, F.lit(0.0)).alias("q"))
    # Common words that the document lacks: half of each one's share.
    missing = F.coalesce("known", F.lit(0.0)) - F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["q"])
    total = divergence(F.array_append(pairs, other)) + missing / 2
    return per_row.select("_id", "_row", F.sqrt(F.greatest(total, F.lit(0.0))).alias("word_distance"))


def judged(
    docs: DataFrame,
    class_limit: float = 0.3,
    word_limit: float = 0.5,
    least_words: int = 50,
    least_reference: int = 2000,
    least_share: float = 0.002,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per row: `doc_id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`,
    `base_failed`, `kept`, `class_distance`, `word_distance`.

    Base: fewer than 20 words, or more than 30 % of the words in windows of 8 that repeat in the
    text. Others are judged by their distances if they have `least_words` words or more and
    their language's documents `least_reference`; they stay up to both limits. Documents below
    the guards stay: nothing can be said of them.

    Null and empty texts have no words and so fail. Documents without a language are one
    language together. Repeated rows have one result and count as often as they are there.
    Further columns are left out; an empty table gives an empty one.
    """
    rows = docs.select(
        *row_key(id_col, text), F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
    )
    counted = class_distance(written(features(rows)))
    sizes = written(counted.groupBy("lang").agg(F.max("_reference").alias("total")))
    words = rows.select("_id", "_row", "lang", F.explode(word_list(F.col("text"))).alias("word"))
    common = written(common_words(words, sizes, least_share))
    distances = word_distance(words, common)
    joined = counted.join(distances, ["_id", "_row"], "left")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    long_enough = (F.col("n_words") >= least_words) & (F.col("_reference") >= least_reference)
    near = (F.coalesce("class_distance", F.lit(0.0)) <= class_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & (~long_enough | near)).alias("kept"), "class_distance", "word_distance",
    )
