"""Quality rules as weak supervision, in DataFrame expressions only.

Each rule votes for quality (1), against it (-1) or abstains (0). One job counts the vote patterns (at most 3 to the power
of the number of rules, 19,683, whatever the input); expectation-maximisation over these counts estimates how often each
rule votes which way on good and on bad documents, and the log-ratios go back into the plan as literals; the posterior probability of quality takes the place of passing all rules. The base rule (fewer than
50 words, or more than half of the words in repeated three-word windows) rejects by itself.

Scale: statistics are expressions of one row; only vote patterns are aggregated, partially before their shuffle.

Defined cases: null and blank texts have no words and fail the base rule; null ids are kept as they are; equal rows get
equal verdicts; an empty table gives no rows; columns of ``docs`` that begin with ``_q_`` are dropped on entry. Positions and
windows work for texts of any length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.llm.base import Workspace

GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
PACKED = 4096  # most words of a text whose windows are sorted as longs
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rule: (statistic, against when this holds, for quality when that holds); neither: the rule abstains.
RULES = {
    "symbols": ("n_symbols / n_words", "> 0.1", "< 0.02"),
    "density": ("n_symbols / word_chars", "> 0.02", "< 0.005"),
    "marked": ("n_marked / n_words", "> 0.1", "< 0.02"),
    "repeats": ("n_repeat_words / n_words", "> 0.4", "< 0.3"),
    "lines": ("n_dup_lines / n_lines", "> 0.5", "< 0.4"),
    "capitals": ("n_capitals / word_chars", "> 0.4", "< 0.25"),
    "shouting": ("n_shouts / n_words", "> 0.2", "< 0.05"),
    "vocabulary": ("n_distinct / n_words", "< 0.1", "> 0.15"),
    "length": ("word_chars / n_words", "NOT BETWEEN 2.5 AND 12", "BETWEEN 3 AND 10"),
}


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (with text) plus the columns of STATS, n_marked, n_lines, n_capitals, n_shouts and n_distinct, prefixed ``_q_``."""
    keep = [c for c in docs.columns if not c.startswith("_q_")]
    cols = [F.col(f"`{c}`") for c in keep]
    df = docs.select(*cols, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_q_text"))
    df = df.select("*", F.expr(f"filter(split(_q_text, r'{GAP}'), x -> x <> '')").alias("_q_words"), F.expr(f"filter(split(_q_text, '\\n'), x -> x rlike r'{WORD}')").alias("_q_lines"))
    df = df.select(
        "*",
        F.size("_q_words").cast("long").alias("_q_n_words"),
        F.expr("cast(ceil(log2(size(_q_words) + 1)) as int)").alias("_q_bits"),
        F.length(F.array_join("_q_words", "")).cast("long").alias("_q_word_chars"),
        F.expr("cast(regexp_count(_q_text, '[#*$%&|<>]') as bigint)").alias("_q_n_symbols"),
        F.expr(f"cast(regexp_count(_q_text, r'[#*$%&|<>]{GAP}') as bigint)").alias("_q_n_marked"),
        F.size("_q_lines").cast("long").alias("_q_n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("_q_n_dup_lines"),
        F.expr(r"cast(regexp_count(_q_text, r'\p{Lu}') as bigint)").alias("_q_n_capitals"),
        F.expr("cast(regexp_count(_q_text, '!') as bigint)").alias("_q_n_shouts"),
        F.size(F.array_distinct("_q_words")).cast("long").alias("_q_n_distinct"),
    ).drop("_q_lines", "_q_text")
    # Hash and position of each three-word window, sorted: equal windows stand side by side. Up to PACKED words both share a
    # long, with at least 52 bits of hash; longer texts sort pairs with the whole hash.
    windows = "slice(_q_words, 1, greatest(size(_q_words) - 2, 0))"
    digest = "xxhash64(x, _q_words[i + 1], _q_words[i + 2])"
    packed = f"sort_array(transform({windows}, (x, i) -> shiftleft({digest}, _q_bits) | cast(i as bigint)))"
    pairs = f"sort_array(transform({windows}, (x, i) -> struct({digest} as h, cast(i as bigint) as p)))"
    df = df.withColumn("_q_packed", F.expr(f"IF(size(_q_words) <= {PACKED}, {packed}, array())"))
    df = df.withColumn("_q_pairs", F.expr(f"IF(size(_q_words) > {PACKED}, {pairs}, array())"))

    def repeated(column: str, hashed: str, place: str) -> str:
        """Places of windows whose three words equal those of the window before or after in the sorted ``column``."""

        def same(x: str, y: str) -> str:
            words = " AND ".join(f"_q_words[cast({place.format(x)} as int) + {k}] = _q_words[cast({place.format(y)} as int) + {k}]" for k in range(3))
            return f"({hashed.format(x)} = {hashed.format(y)} AND {words})"

        before, after = same("e", f"{column}[k - 1]"), same("e", f"{column}[k + 1]")
        return f"transform(filter({column}, (e, k) -> (k > 0 AND {before}) OR (k < size({column}) - 1 AND {after})), e -> {place.format('e')})"

    short = repeated("_q_packed", "shiftright({0}, _q_bits)", "({0} & (shiftleft(1L, _q_bits) - 1))")
    long = repeated("_q_pairs", "{0}.h", "{0}.p")
    df = df.withColumn("_q_places", F.expr(f"sort_array(IF(size(_q_words) <= {PACKED}, {short}, {long}))"))
    covered = "aggregate(transform(_q_places, (p, k) -> IF(k < size(_q_places) - 1, least(3L, _q_places[k + 1] - p), 3L)), 0L, (a, x) -> a + x)"
    return df.withColumn("_q_n_repeat_words", F.expr(covered)).drop("_q_words", "_q_packed", "_q_pairs", "_q_places", "_q_bits")


def _own(text: str) -> str:
    for name in ("n_words", "word_chars", "n_symbols", "n_marked", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts", "n_distinct"):
        text = " ".join(f"_q_{x}" if x == name else x for x in text.split())
    return text


def votes(df: DataFrame) -> DataFrame:
    """A column ``_q_vote_<rule>`` per rule. A ratio without a denominator abstains."""
    for name, (ratio, against, good) in RULES.items():
        top, bottom = _own(ratio).split(" / ")
        value = f"({top} / nullif({bottom}, 0))"
        df = df.withColumn(f"_q_vote_{name}", F.expr(f"CASE WHEN {value} {against} THEN -1 WHEN {value} {good} THEN 1 ELSE 0 END"))
    return df


def base_failed() -> Column:
    return F.expr("_q_n_words < 50 OR 100 * _q_n_repeat_words > 50 * _q_n_words")


class Model:
    """Class prior and P(vote | class) of each rule; class 1 is quality. ``_q_code`` holds rule * 3 + vote + 1 per rule."""

    def __init__(self, prior: float = 0.8):
        self.prior = prior
        self.by = {1: [0.03, 0.2, 0.77] * len(RULES), 0: [0.35, 0.2, 0.45] * len(RULES)}

    def posterior(self) -> Column:
        """P(quality | votes) as an expression of ``_q_code``."""
        ratios = F.lit([math.log(g / b) for g, b in zip(self.by[1], self.by[0], strict=True)])
        odds = F.aggregate("_q_code", F.lit(math.log(self.prior / (1 - self.prior))), lambda a, c: a + F.get(ratios, c))
        return 1 / (1 + F.exp(-odds))

    def fit(self, patterns: list[tuple[list[int], int]], turns: int = 30, smooth: float = 1.0, settled: float = 1e-6) -> Model:
        """EM over (codes, rows) of each pattern. A rule never counts as worse than chance: bad documents get at least its
        share of -1."""
        for _ in range(turns if patterns else 0):
            ratios, prior = [math.log(g / b) for g, b in zip(self.by[1], self.by[0], strict=True)], math.log(self.prior / (1 - self.prior))
            sums, before = [[0.0] * len(ratios), [0.0] * len(ratios)], (self.prior, *self.by[1], *self.by[0])
            for codes, n in patterns:
                p = 1 / (1 + math.exp(-(prior + sum(ratios[c] for c in codes))))
                for c in codes:
                    sums[0][c] += p * n
                    sums[1][c] += (1 - p) * n
            good, bad = (sum(x[:3]) for x in sums)  # each row votes once per rule
            self.prior = min(max((good + smooth) / (good + bad + 2 * smooth), 0.01), 0.99)
            for y, k, total in ((1, 0, good), (0, 1, bad)):
                self.by[y] = [(x + smooth) / (total + 3 * smooth) for x in sums[k]]
            for c in range(0, 3 * len(RULES), 3):
                self.by[0][c] = max(self.by[0][c], self.by[1][c])
                self.by[1][c + 2] = max(self.by[1][c + 2], self.by[0][c + 2])
            if max(abs(x - y) for x, y in zip(before, (self.prior, *self.by[1], *self.by[0]), strict=True)) < settled:
                break
        return self


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` plus the ``_q_`` statistics, votes, ``_q_base_failed``, ``_q_posterior`` and ``_q_kept``."""
    ws = Workspace(docs.sparkSession, "quality")
    code = F.array(*((F.col(f"_q_vote_{r}") + (3 * k + 1)).cast("int") for k, r in enumerate(RULES)))
    judged = ws.keep(votes(statistics(docs)).withColumn("_q_base_failed", base_failed()).withColumn("_q_code", code), "votes")
    # At most 3 to the power of the number of rules, whatever the input; in a fixed order, so that sums repeat.
    patterns = sorted((r["_q_code"], r["n"]) for r in judged.groupBy("_q_code").agg(F.count("*").alias("n")).collect())
    judged = judged.withColumn("_q_posterior", Model().fit(patterns).posterior())
    return judged.withColumn("_q_kept", ~F.col("_q_base_failed") & (F.col("_q_posterior") >= 0.5))


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, the base statistics, base_failed, kept) of every row."""
    judged = judge(docs.select("doc_id", "text"))
    return judged.select("doc_id", *(F.col(f"_q_{c}").alias(c) for c in STATS), F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"))


def _oracle() -> str:
    """The query in DuckDB's SQL: statistics by unnesting, EM as a recursive table over the list of vote patterns."""
    votes = []
    for k, (ratio, against, good) in enumerate(RULES.values()):
        top, bottom = ratio.split(" / ")
        value = f"({top}::DOUBLE / nullif({bottom}, 0))"
        votes.append(f"{3 * k + 2} + CASE WHEN {value} {against} THEN -1 WHEN {value} {good} THEN 1 ELSE 0 END")
    start, rules = Model(), len(RULES)
    doubles = lambda xs: "[" + ", ".join(f"{x}::DOUBLE" for x in xs) + "]"
    odds = "ln(prior / (1 - prior)) + list_sum(list_transform({0}, lambda c: ln(g[c] / b[c])))"
    share = lambda p: f"list_transform(range(1, {3 * rules + 1}), lambda c: coalesce(list_sum(list_transform(pats, lambda x: CASE WHEN list_contains(x.code, c) THEN x.n * {p} ELSE 0.0 END)), 0.0))"
    p = f"(1 / (1 + exp(-({odds.format('x.code')}))))"
    norm = lambda sums, total: f"list_transform({sums}, lambda v: (v + 1.0) / ({total} + 3.0))"
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
i AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) > 2),
k AS (SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n FROM i),
c AS (SELECT r, least(3, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 3)) AS m FROM k WHERE n > 1),
q AS (SELECT r, sum(m)::BIGINT AS n_repeat_words FROM c GROUP BY r),
s AS (SELECT w.r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  len(regexp_extract_all(t, '[#*$%&|<>][\x20\x09-\x0D]+')) AS n_marked, len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_capitals,
  len(regexp_extract_all(t, '!')) AS n_shouts, len(list_distinct(w)) AS n_distinct, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN q ON q.r = w.r),
v AS (SELECT *, [{", ".join(votes)}] AS code FROM s),
pt AS (SELECT list({{'code': code, 'n': n}} ORDER BY code) AS pats FROM (SELECT code, count(*) AS n FROM v GROUP BY code)),
em(turn, prior, g, b, done) AS (
  SELECT 0, {start.prior}::DOUBLE, {doubles(start.by[1])}, {doubles(start.by[0])}, false
  UNION ALL
  SELECT turn + 1, np, ng, nb, greatest(abs(np - prior), list_max(list_transform(range(1, {3 * rules + 1}), lambda c: greatest(abs(ng[c] - g[c]), abs(nb[c] - b[c]))))) < 1e-6 FROM (
    SELECT turn, prior, g, b, np, list_transform(range(1, {3 * rules + 1}), lambda c: CASE WHEN c % 3 = 0 THEN greatest(ng[c], nb[c]) ELSE ng[c] END) AS ng,
      list_transform(range(1, {3 * rules + 1}), lambda c: CASE WHEN c % 3 = 1 THEN greatest(ng[c], nb[c]) ELSE nb[c] END) AS nb FROM (
      SELECT *, least(greatest((good + 1.0) / (good + bad + 2.0), 0.01), 0.99) AS np, {norm('sg', 'good')} AS ng, {norm('sb', 'bad')} AS nb FROM (
        SELECT *, sg[1] + sg[2] + sg[3] AS good, sb[1] + sb[2] + sb[3] AS bad FROM (
          SELECT em.*, {share(p)} AS sg, {share(f'(1 - {p})')} AS sb FROM em, pt WHERE turn < 30 AND NOT done))))),
m AS (SELECT * FROM em ORDER BY turn DESC LIMIT 1),
o AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {odds.format('code')} AS odds FROM v, m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND odds >= 0 AS kept FROM o
"""


ORACLE = _oracle()
