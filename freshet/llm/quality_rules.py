"""Quality rules as weak supervision: rules vote or abstain, EM estimates their accuracies, a posterior decides.

DataFrame functions only. Every statistic is computed inside its row by array functions, so documents are never
exploded or shuffled; the only shuffle counts vote patterns (at most 3^rules rows, map-side combined), on which plain
arithmetic on the driver runs EM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.storage import save

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: rule: (statistic, vote, beyond which value it votes); votes are -1 bad and 1 good, every rule may abstain (0). Rules
#: are one-sided: that a text is not all capitals says little about a text that is all symbols.
RULES = {
    "repeats": ("repeat_share", -1, 0.2),
    "symbols": ("symbol_share", -1, 0.03),
    "symbol_words": ("symbol_word_share", -1, 0.15),
    "lines": ("dup_line_share", -1, 0.45),
    "capitals": ("capital_share", -1, 0.4),
    "marks": ("mark_share", -1, 0.08),
    "sentences": ("stop_share", 1, 0.03),
}


def with_repeated_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """Adds ``out``: words in 5-word windows found twice or more in the text, the first finding included.

    Windows are compared by 64-bit hash. Texts without a repeated window, nearly all, stop after one hash set; the
    others sort (hash, position) pairs, keep positions whose hash has an equal neighbour and sum the cover of the
    windows at those positions. Each step is a column of its own: a lambda would evaluate an inlined one per element.
    """
    docs = docs.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in range(WINDOW)))
    )
    docs = docs.withColumn("_windows", F.when(F.size("_hashes") > WINDOW, windows))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_pairs", F.when(repeated, pairs))
    twice = F.filter(
        "_pairs",
        lambda p, k: F.get("_pairs", k - 1)["h"].eqNullSafe(p["h"]) | F.get("_pairs", k + 1)["h"].eqNullSafe(p["h"]),
    )
    docs = docs.withColumn("_at", F.array_sort(F.transform(twice, lambda p: p["i"])))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        "_at", start,
        lambda acc, p: F.struct((acc["n"] + F.least(p - acc["last"], F.lit(WINDOW))).cast("long").alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    return docs.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop("_hashes", "_windows", "_pairs", "_at")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds to ``docs`` the columns ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the shares the
    rules read. A null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("_text", text)
    out = out.withColumn("_words", F.filter(F.split("_text", SPACE + "+", -1), lambda w: w != ""))
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_capitals": (F.length("_text") - F.length(F.regexp_replace("_text", "[A-Z]", ""))),
        "_marks": (F.length("_text") - F.length(F.regexp_replace("_text", "[!?]", ""))),
        "_stops": (F.length("_text") - F.length(F.regexp_replace("_text", r"\.(?=\s|$)", ""))),
        "_symbol_words": F.size(F.filter("_words", lambda w: w.rlike(SYMBOLS))),
    })
    out = with_repeated_words(out, "_words", "n_repeat_words")
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return out.withColumns({
        "repeat_share": F.col("n_repeat_words") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
        "capital_share": F.col("_capitals") / chars,
        "mark_share": F.col("_marks") / chars,
        "stop_share": F.col("_stops") / words,
        "symbol_word_share": F.col("_symbol_words") / words,
    }).drop("_text", "_words", "_lines", "_n_lines", "_capitals", "_marks", "_stops", "_symbol_words")


def vote(rule: str) -> Column:
    stat, value, beyond = RULES[rule]
    return F.when(F.col(stat) > beyond, value).otherwise(0)


def fit(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, list[dict[int, float]]]:
    """EM over counted vote patterns: the share of good documents, and for each rule the log-odds that each of its
    votes (abstaining included) adds. Each rule has one distribution of votes for good and one for bad documents,
    smoothed by one pseudo-count; it starts from rules that find two fifths of their class and a fiftieth of the other."""
    n_rules = len(next(iter(patterns))) if patterns else 0
    prior = 0.8
    like = [{1: {1: 0.4, 0: 0.58, -1: 0.02}, 0: {1: 0.1, 0: 0.5, -1: 0.4}} for _ in range(n_rules)]
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        good_n = 0.0
        seen = [{1: {1: 0.4, 0: 0.5, -1: 0.1}, 0: {1: 0.1, 0: 0.5, -1: 0.4}} for _ in range(n_rules)]
        for votes, n in patterns.items():
            odds = math.log(prior / (1 - prior)) + sum(math.log(like[r][1][v] / like[r][0][v]) for r, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good_n += p * n
            for r, v in enumerate(votes):
                seen[r][1][v] += p * n
                seen[r][0][v] += (1 - p) * n
        prior = min(1 - 1e-6, max(1e-6, (good_n + 1) / (total + 2)))
        for r in range(n_rules):
            for z in (0, 1):
                s = sum(seen[r][z].values())
                like[r][z] = {v: x / s for v, x in seen[r][z].items()}
    return prior, [{v: math.log(x[1][v] / x[0][v]) for v in (1, 0, -1)} for x in like]


def _voted(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> tuple[DataFrame, Column, Column]:
    """A written table of statistics and votes, of whole rows too if asked, with its verdict columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole else F.lit(None).cast("int")
    stats = statistics(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"), row.alias("_row")), "_raw")
    votes = [f"_v_{r}" for r in RULES]
    voted = stats.withColumns({f"_v_{r}": vote(r) for r in RULES})
    voted = save(voted.select("_id", "_row", *STATISTICS, *votes), "votes")
    counted = voted.groupBy(*votes).count().collect()  # at most 3^rules rows
    prior, odds = fit({tuple(r[:-1]): r[-1] for r in counted})
    total = F.lit(math.log(prior / (1 - prior)))
    for name, table in zip(votes, odds):
        total = total + F.when(F.col(name) == 1, table[1]).when(F.col(name) == -1, table[-1]).otherwise(table[0])
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    posterior = 1 / (1 + F.exp(-total))
    return voted, failed, posterior


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Statistics, votes, posterior and verdict of every row.

    Returns ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, posterior, kept``.
    ``base_failed``: under ten words, or over a fifth of them repeated; such rows are not kept. Otherwise a row is kept
    if its posterior quality probability is at least ``least``. Null and empty texts have no words and fail; repeated
    rows are judged alike; an empty table gives an empty result; other columns are ignored.
    """
    voted, failed, posterior = _voted(docs, id_col, text_col, whole=False)
    return voted.select(
        F.col("_id").alias(id_col), *STATISTICS, failed.alias("base_failed"), posterior.alias("posterior"), (~failed & (posterior >= least)).alias("kept"),
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    voted, failed, posterior = _voted(docs, id_col, text_col, whole=True)
    return voted.where(~failed & (posterior >= least)).select("_row.*")
