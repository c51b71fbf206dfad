"""Personal data in texts, with DataFrame functions only: patterns propose, checksums confirm, words nearby adjust the score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are the base; ``iban`` and ``ssn`` are added. A pattern's matches are leftmost
and non-overlapping within its kind. A match is confirmed by its kind's rule: an address' parts at most 255, 12 to 19 digits
that pass Luhn's check, 9 to 15 digits of a phone number, an IBAN whose number is 1 mod 97, a social security number's
ranges. A confirmed match scores its kind's ``SCORE``, more where one of the kind's ``NEAR`` words and less where one of the
``FAR`` words stands within ``BEFORE`` characters before or ``AFTER`` behind it (up to the neighbouring match of the kind).
Confirmed base spans always stay; added ones need a score of ``LEAST`` or more.

Every pattern is read in time linear in the text: no repetition backtracks, and a run of characters is entered at its first one
only. Positions are running sums over a text's gaps and matches: one narrow row per match is dealt by text, so that texts with
very many matches are sorted on disk rather than held as nested arrays, and the texts themselves are never shuffled.

Defined results: a null text is an empty one and has no spans; rows that repeat are scanned alike, each on its own; null
doc_ids stay; other columns are ignored; an empty table gives no rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import table

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4

#: Equivalents of the plain patterns without backtracking. A match of ``email`` or ``card`` begins where a run does, or (of
#: ``email``) where the match before ended; ``card`` proposes runs of 12 digits or more, as shorter ones fail anyway.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}

#: Scores of confirmed matches, and words that raise or lower them, in lower case.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
NEAR = {
    "email": ("contact", "email", "mail", "write"),
    "ip": ("address", "from", "host", "ip", "login", "server"),
    "card": ("amex", "card", "credit", "debit", "mastercard", "payment", "visa"),
    "phone": ("call", "cell", "fax", "mobile", "phone", "tel", "telephone"),
    "iban": ("account", "bank", "iban", "konto", "transfer"),
    "ssn": ("security", "social", "ssn"),
}
FAR = {
    "email": ("example",),
    "ip": ("release", "section", "version"),
    "card": ("article", "isbn", "order", "serial"),
    "phone": ("isbn", "order", "serial"),
    "iban": ("hash", "serial", "sku"),
    "ssn": ("isbn", "part", "serial", "sku"),
}
MORE, FEWER, LEAST = 0.2, 0.2, 0.5
BEFORE, AFTER = 60, 30
#: Four numbers of at most 255.
BYTES = r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)(\.|$)){4}$"
#: Digits as Luhn's check counts every second one.
DOUBLED = "0246813579"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """For up to 20 digits; zeros in front change nothing."""
    padded = F.lpad(digits, 20, "0")
    place = lambda i: F.substring(padded, i, 1)
    single = [place(i).cast("int") for i in range(2, 21, 2)]
    double = [F.translate(place(i), "0123456789", DOUBLED).cast("int") for i in range(1, 20, 2)]
    return reduce(lambda a, b: a + b, single + double) % 10 == 0


def _mod_97(number: Column) -> Column:
    """The remainder of a number whose digits may be letters (A is 10, Z is 35), read from left to right."""
    step = lambda acc, c: F.when(c >= "A", acc * 100 + (F.ascii(c) - 55)).otherwise(acc * 10 + (F.ascii(c) - 48)) % 97
    return F.aggregate(F.split(number, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))


def _confirmed(kind: str, match: Column, before: Column, after: Column) -> Column:
    digits = _digits(match)
    alone = ~F.right(before, F.lit(1)).rlike("[A-Za-z0-9-]") & ~F.left(after, F.lit(1)).rlike("[A-Za-z0-9-]")
    if kind == "ip":
        return match.rlike(BYTES)
    if kind == "card":
        return F.when(F.length(digits) <= 19, _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        number = F.replace(match, F.lit(" "), F.lit(""))
        turned = F.concat(F.substring(number, 5, 40), F.substring(number, 1, 4))
        return F.length(number).between(15, 34) & alone & (_mod_97(turned) == 1)
    if kind == "ssn":
        return alone & ~match.rlike("^(000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def _worded(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike(f"(^|[^a-z])({'|'.join(words)})([^a-z]|$)")


def _score(kind: str, match: Column, before: Column, after: Column) -> Column:
    """The score of a match, null if it is not confirmed. before, after: the gaps on both sides."""
    around = F.concat(F.right(before, F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER)))
    score = (F.lit(SCORE[kind]) + F.when(_worded(around, NEAR[kind]), F.lit(MORE)).otherwise(F.lit(0.0))
             - F.when(_worded(around, FAR[kind]), F.lit(FEWER)).otherwise(F.lit(0.0)))
    return F.when(_confirmed(kind, match, before, after), F.round(F.least(score, F.lit(1.0)), 2))


def _proposals(docs: DataFrame) -> DataFrame:
    """_row, doc_id, and a row per match: kind (number), place (in its text, from 0), gap and size (lengths), score. Texts
    without a match have one row with nulls."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("_row", F.monotonically_increasing_id())
    # What a text must hold for a kind's pattern to be worth trying.
    hint = {k: F.col("text").rlike("[0-9]") for k in KINDS} | {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    none = F.array().cast("array<string>")
    rows = rows.select("_row", "doc_id", *[
        F.when(hint[k], F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"m_{k}") for k in KINDS], *[
        F.when(hint[k], F.split("text", PATTERNS[k], -1)).otherwise(none).alias(f"g_{k}") for k in KINDS])

    def found(number: int, kind: str) -> Column:
        n = F.size(f"m_{kind}")
        sides = F.arrays_zip(F.col(f"m_{kind}").alias("m"), F.slice(f"g_{kind}", F.lit(1), n).alias("before"),
                             F.slice(f"g_{kind}", F.lit(2), n).alias("after"))
        return F.transform(sides, lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("place"), F.length(x["before"]).alias("gap"), F.length(x["m"]).alias("size"),
            _score(kind, x["m"], x["before"], x["after"]).alias("score")))

    matches = F.concat(*[found(i, k) for i, k in enumerate(KINDS)])
    return rows.select("_row", "doc_id", F.explode_outer(matches).alias("x")).select("_row", "doc_id", "x.*")


def find_pii(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, spans (array of start, kind, end, score in that order; kind is a place in ``KINDS``), a row per document."""
    order = W.partitionBy("_row", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (_proposals(docs).repartition("_row").withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(order))
              .withColumn("start", F.col("end") - F.col("size")))
    stays = F.col("score").isNotNull() & ((F.col("kind") < BASE) | (F.col("score") >= least))
    return placed.groupBy("_row", "doc_id").agg(F.sort_array(F.collect_list(
        F.when(stays, F.struct("start", "kind", "end", "score")))).alias("spans")).select("doc_id", "spans")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: counts and digest of the base spans, all spans, and their scores."""
    found = find_pii(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:BASE]],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


def _sql_words(words: tuple[str, ...]) -> str:
    return f"(^|[^a-z])({'|'.join(words)})([^a-z]|$)"


def _sql() -> str:
    """The same in DuckDB: plain patterns, running sums by window."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": PATTERNS["iban"],
        "ssn": PATTERNS["ssn"],
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    number = "replace(m, ' ', '')"
    alone = "NOT regexp_matches(right(before, 1), '[A-Za-z0-9-]') AND NOT regexp_matches(left(after, 1), '[A-Za-z0-9-]')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 "
            f"THEN substr(reverse({digits}), i, 1)::INT ELSE substr('{DOUBLED}', substr(reverse({digits}), i, 1)::INT + 1, 1)::INT END)) % 10 = 0")
    mod_97 = ("list_reduce(list_transform(string_split(substr({n}, 5) || substr({n}, 1, 4), ''), lambda c: CASE WHEN c >= 'A' "
              "THEN ascii(c) - 55 ELSE ascii(c) - 48 END), lambda a, d: (CASE WHEN d > 9 THEN a * 100 + d ELSE a * 10 + d END) % 97) = 1").format(n=number)
    rule = {
        "email": "TRUE",
        "ip": f"regexp_matches(m, '{BYTES}')",
        "card": f"CASE WHEN length({digits}) BETWEEN 12 AND 19 THEN {luhn} ELSE FALSE END",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"length({number}) BETWEEN 15 AND 34 AND {alone} AND CASE WHEN m IS NULL THEN FALSE ELSE {mod_97} END",
        "ssn": f"{alone} AND NOT regexp_matches(m, '^(000|666|9..)-|-00-|-0000$')",
    }
    around = f"lower(right(before, {BEFORE}) || ' ' || left(after, {AFTER}))"
    kinds = " UNION ALL ".join(
        f"SELECT r, {i} AS kind, '{k}' AS name, place, length(before) AS gap, length(m) AS size, CASE WHEN {rule[k]} THEN round(least("
        f"CAST({SCORE[k]} AS DOUBLE) + CASE WHEN regexp_matches({around}, '{_sql_words(NEAR[k])}') THEN CAST({MORE} AS DOUBLE) ELSE 0 END "
        f"- CASE WHEN regexp_matches({around}, '{_sql_words(FAR[k])}') THEN CAST({FEWER} AS DOUBLE) ELSE 0 END, 1), 2) END AS score "
        f"FROM (SELECT r, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS place, unnest(gs[1:len(ms)]) AS before, unnest(gs[2:len(ms) + 1]) AS after "
        f"FROM (SELECT r, regexp_extract_all(text, '{plain[k]}', 0) AS ms, string_split_regex(text, '{plain[k]}') AS gs FROM d))"
        for i, k in enumerate(KINDS))
    joined = "coalesce(string_agg(concat(name, ':', fin - size, ':', fin), ',' ORDER BY fin - size, kind){w}, '')"
    base = joined.format(w=f" FILTER (kind < {BASE})")
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(KINDS[:BASE]))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({kinds}),
p AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY place) AS BIGINT) AS fin FROM f),
s AS (SELECT r, {counts}, sha256({base}) AS base_sha256, {joined.format(w='')} AS spans,
      coalesce(string_agg(printf('%.2f', score), ',' ORDER BY fin - size, kind), '') AS scores
      FROM p WHERE score IS NOT NULL AND (kind < {BASE} OR score >= {LEAST}) GROUP BY r)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in KINDS[:BASE])}, coalesce(base_sha256, sha256('')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN s USING (r)"""


OP12_SQL = _sql()
