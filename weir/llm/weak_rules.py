"""Quality rules by weak supervision: each rule votes or abstains, and what its votes are worth is estimated.

No rule decides alone. Whether a document is good is a hidden variable; a rule that votes does so with one
accuracy on good documents and another on bad ones. Expectation-maximisation over the vote patterns of all documents
estimates these and the share of good documents, and a document is kept if it is good more probably than not.

Votes and estimates are DataFrame functions throughout. A round of the estimation aggregates the table of patterns,
which has at most 3^rules rows however many documents there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import stored

#: What separates words, and the characters that count as symbols.
BLANKS, SYMBOLS = r"\x20\x09-\x0D", "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is it for was on are with as this that "
    "le la les de et en un une pour dans que pas "
    "der die das und zu den mit von für ist ein nicht "
    "el los las por con para del se no es"
).split()


@dataclass(frozen=True)
class Rule:
    """Conditions on the measured columns under which a rule calls a document bad or good; else it abstains."""

    name: str
    bad: str
    good: str


#: Shares are compared in whole numbers. Texts without words get no vote.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "2 * word_chars BETWEEN 7 * n_words AND 13 * n_words"),
    Rule("function_words", "50 * n_function_words < n_words", "50 * n_function_words >= 3 * n_words"),
    Rule("repeated_words", "5 * n_repeat_words > n_words", "20 * n_repeat_words <= n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "10 * n_dup_lines <= n_lines"),
    Rule("sentence_ends", "50 * n_ends < n_words", "100 * n_ends BETWEEN 4 * n_words AND 25 * n_words"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars", "10 * n_capitals <= word_chars"),
    Rule("digits", "20 * n_digits > 3 * word_chars", "20 * n_digits <= word_chars"),
    Rule("variety", "5 * n_distinct_words < n_words AND n_words <= 2000", "5 * n_distinct_words >= 2 * n_words"),
)

#: Start of the estimation, and rounds of it.
START, ROUNDS = 0.8, 20


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


#: Places in a text are written with as many digits as this has.
_FIRST = 1_000_000_000


def _repeated(words: Column) -> Column:
    """How many of the words lie in windows of three that occur twice or more.

    If the windows' hashes are all different, none does. Else the windows are sorted as text, each with its place: words hold no
    blanks, so equal windows stand side by side.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.transform(
        starts, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2), (i + F.lit(_FIRST)).cast("string")))

    def repeats(ordered: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.substring_index(F.get(ordered, k), " ", 3) == F.substring_index(x, " ", 3), F.lit(False))

        found = F.filter(ordered, lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(F.lit(False)) | same(x, k + 1))
        return F.sort_array(F.transform(found, lambda x: F.substring_index(x, " ", -1).cast("int") - _FIRST))

    # A window three places or more after the one before adds three words, else as many as it lies after it.
    def covered(places: Column) -> Column:
        none = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-3).alias("last"))
        return F.aggregate(
            places, none, lambda a, p: F.struct((a["words"] + F.least(F.lit(3), p - a["last"])).alias("words"), p.alias("last")), lambda a: a["words"])

    found = _with(F.sort_array(windows), lambda ordered: _with(repeats(ordered), covered))
    some = (F.size(words) >= 3) & (F.size(F.array_distinct(hashes)) < F.size(words) - 2)
    return F.when(some, found).otherwise(F.lit(0).cast("long"))


def _measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    def of_words(words: Column) -> list[Column]:
        return [
            F.size(words).alias("n_words"),
            F.length(F.array_join(words, "")).alias("word_chars"),
            _repeated(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(FUNCTION_WORDS))).alias("n_function_words"),
            F.size(F.array_distinct(words)).alias("n_distinct_words"),
        ]

    def of_lines(lines: Column) -> list[Column]:
        return [F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines")]

    def number_of(characters: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{characters}]"))

    words = F.regexp_extract_all(text, F.lit(f"([^{BLANKS}]+)"), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    return F.struct(
        _with(words, lambda w: F.struct(*of_words(w))).alias("of_words"),
        _with(lines, lambda x: F.struct(*of_lines(x))).alias("of_lines"),
        number_of(SYMBOLS).alias("n_symbols"), number_of("A-Z").alias("n_capitals"), number_of("0-9").alias("n_digits"),
        F.regexp_count(text, F.lit(f"[.!?](?=[{BLANKS}]|\\z)")).alias("n_ends"),
    )


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_function_words", "n_ends",
    "n_distinct_words", "n_capitals", "n_digits",
)


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, measures as longs, votes: 1, -1 or 0 per rule), a row per document, each text read where it lies."""
    held = docs.select(F.col(id).alias("id"), _measures(F.coalesce(F.col(text), F.lit(""))).alias("_m"))
    places = {"n_lines": "of_lines", "n_dup_lines": "of_lines", "n_symbols": None, "n_capitals": None, "n_digits": None, "n_ends": None}
    fields = [F.col(".".join(filter(None, ["_m", places.get(m, "of_words"), m]))).cast("long").alias(m) for m in MEASURES]
    votes = [
        F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END").cast("tinyint")
        for r in rules
    ]
    return held.select("id", *fields).withColumn("votes", F.array(*votes))


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; per rule, how often its votes are right on good and on bad ones."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def quality(self, votes: Column) -> Column:
        """Probability that a document is good, by the array of its votes."""
        right = F.array(*[F.lit(math.log(a / (1 - b))) for a, b in zip(self.on_good, self.on_bad)])
        wrong = F.array(*[F.lit(math.log((1 - a) / b)) for a, b in zip(self.on_good, self.on_bad)])
        terms = F.transform(votes, lambda v, j: F.when(v == 1, F.get(right, j)).when(v == -1, F.get(wrong, j)).otherwise(F.lit(0.0)))
        odds = F.aggregate(terms, F.lit(math.log(self.prior / (1 - self.prior))), lambda a, x: a + x)
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over ``patterns``: arrays of ``votes`` and ``n``, the number of documents that have them.

    One document more of each outcome counts as seen, so no estimate is 0 or 1; a vote is never taken for the
    opposite of what it says. A round brings a sum per rule and vote to the driver.
    """
    model = LabelModel(0.5, (START,) * rules, (START,) * rules)
    for _ in range(rounds):
        good = (F.col("n") * F.col("_quality")).alias("good")
        cast = patterns.withColumn("_quality", model.quality(F.col("votes"))).select("n", good, F.posexplode("votes").alias("rule", "vote"))
        sums = {(r.rule, r.vote): (r.good, r.n - r.good) for r in cast.groupBy("rule", "vote").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect()}
        if not sums:
            return model

        def share(rule: int, vote: int, side: int) -> float:
            right, other = (sums.get((rule, v), (0.0, 0.0))[side] for v in (vote, -vote))
            return (right + 1) / (right + other + 2)

        on_good = tuple(share(j, 1, 0) for j in range(rules))
        on_bad = tuple(max(share(j, -1, 1), 1 - a) for j, a in enumerate(on_good))
        all_good, all_bad = (sum(sums.get((0, v), (0.0, 0.0))[side] for v in (-1, 0, 1)) for side in (0, 1))
        model = LabelModel((all_good + 1) / (all_good + all_bad + 2), on_good, on_bad)
    return model


def judge_documents(
    docs: DataFrame, rules: Sequence[Rule] = RULES, least: float = 0.5, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, LabelModel]:
    """(id, measures, votes, base_failed, quality, kept) per row of ``docs``, and the estimated model.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows of three; such documents are not
    kept. Others are kept if their ``quality`` is ``least`` or better; the votes on all of them make the model, those on
    repeated rows as often as they occur. A null text is an empty one, has no votes and fails; a null id stays null. An empty table has no rows.
    Other columns are not read, and no Python runs in the tasks. A text's words and their windows are held at a time in its task, about
    200 bytes a word.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = stored(measured(docs, rules, id, text).withColumn("base_failed", failed), "measured")
    patterns = stored(found.where("NOT base_failed").groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    model = fit(patterns, len(rules))
    judged = found.withColumn("quality", model.quality(F.col("votes")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)), model


def judge_sql(rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> str:
    """The documents' measures and verdicts in SQL; a CTE for each round of the estimation."""
    lower = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)
    votes = ",\n".join(
        f"CASE WHEN n_words = 0 THEN 0 WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{j}" for j, r in enumerate(rules))
    m = range(len(rules))

    def quality(model: str) -> str:
        terms = " + ".join(f"CASE v{j} WHEN 1 THEN ln({model}.a{j} / (1 - {model}.b{j})) WHEN -1 THEN ln((1 - {model}.a{j}) / {model}.b{j}) ELSE 0 END" for j in m)
        return f"1 / (1 + exp(-(ln({model}.p / (1 - {model}.p)) + {terms})))"

    start = ", ".join(["0.5::DOUBLE AS p"] + [f"{START}::DOUBLE AS a{j}, {START}::DOUBLE AS b{j}" for j in m])
    steps = [f"m0 AS MATERIALIZED (SELECT {start})"]
    for k in range(rounds):
        good = [f"(coalesce(sum(g) FILTER (v{j} = 1), 0) + 1) / (coalesce(sum(g) FILTER (v{j} <> 0), 0) + 2)" for j in m]
        bad = [f"(coalesce(sum(n - g) FILTER (v{j} = -1), 0) + 1) / (coalesce(sum(n - g) FILTER (v{j} <> 0), 0) + 2)" for j in m]
        fields = ", ".join(["(coalesce(sum(g), 0) + 1) / (coalesce(sum(n), 0) + 2) AS p"] + [f"{good[j]} AS a{j}, greatest({bad[j]}, 1 - {good[j]}) AS b{j}" for j in m])
        steps.append(f"m{k + 1} AS MATERIALIZED (SELECT {fields} FROM (SELECT *, n * {quality(f'm{k}')} AS g FROM patterns, m{k}))")
    return f"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{BLANKS}]')) AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, unnest(range(1, len(words) - 1)) AS place,
               unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS win
        FROM texts
    ), repeats AS (
        SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
    ), covered AS (
        SELECT doc_id, CAST(sum(least(3, place - before)) AS BIGINT) AS n
        FROM (SELECT *, coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY place), -3) AS before FROM repeats)
        GROUP BY doc_id
    ), counted AS MATERIALIZED (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
               len(lines) AS n_lines, len(list_filter(words, lambda w: lower(w) IN ({lower}))) AS n_function_words,
               len(list_filter(words, lambda w: right(w, 1) IN ('.', '!', '?'))) AS n_ends, len(list_distinct(words)) AS n_distinct_words,
               length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
        FROM texts LEFT JOIN covered USING (doc_id)
    ), voted AS MATERIALIZED (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {votes} FROM counted
    ), patterns AS MATERIALIZED (
        SELECT {", ".join(f"v{j}" for j in m)}, count(*) AS n FROM voted WHERE NOT base_failed GROUP BY ALL
    ), {", ".join(steps)}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           base_failed, NOT base_failed AND {quality(f"m{rounds}")} >= 0.5 AS kept
    FROM voted, m{rounds}
    """
