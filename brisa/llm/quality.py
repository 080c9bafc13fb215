"""Quality by weak supervision, in DataFrame functions only.

Each rule looks at a text and votes keep (1) or drop (-1), or abstains (0). Documents
are counted by their pattern of votes (at most 3 ** 9 patterns), and expectation
maximisation over the counted patterns estimates how often each rule, when it votes,
is for keeping good and bad texts, without labels. A document's posterior probability
of being good then weighs all its votes; abstaining says nothing, no single rule decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import stored, words

RUN = 8
ROUNDS = 40
#: Prior share of good texts that EM starts from, and the weight of its first guesses.
START = 0.8
PSEUDO = 2.0
#: First guess of the chances of (drop, keep) of a rule that votes on a bad, a good text.
GUESS_BAD = (0.5, 0.5)
GUESS_GOOD = (0.01, 0.99)
#: No vote is taken to be rarer than this: one rule alone cannot settle a case.
RAREST = 0.01


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _repeats(w: Column) -> Column:
    """Words inside windows of RUN words that are found twice or more, first included."""
    last = F.size(w) - RUN
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(RUN)])
    )

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, j: (F.get(s, j - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, j + 1)["h"].eqNullSafe(x["h"])),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: b - a)
            return F.aggregate(
                steps, F.lit(0), lambda s, d: s + F.least(F.coalesce(d, F.lit(RUN)), F.lit(RUN))
            )

        return bound(pairs, lambda s: bound(places(s), total))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    return F.when(last < 1, 0).otherwise(bound(windows, counted))


def features(text: Column) -> Column:
    """Struct of the figures that the rules look at; a null text has no words."""
    text = F.coalesce(text, F.lit(""))

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{pattern}]+", ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeats(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.rlike(r"[\p{L}\p{N}]"))).alias("n_real"),
            F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))).alias("n_stutter"),
            F.size(F.filter(w, lambda x: x.rlike(r"[.?!][\"')\]]*$"))).alias("n_ends"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines")
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        bound(words(text), of_words).alias("w"),
        bound(lines, of_lines).alias("l"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        count(r"\p{L}").alias("n_letters"),
        count(r"\p{Lu}").alias("n_upper"),
    )


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the figures as columns (replacing columns of their names)."""
    df = df.withColumn("__f", features(F.col(text)))
    parts = {n: F.col(f"__f.w.{n}") for n in ("n_words", "word_chars", "n_repeat_words", "n_real", "n_stutter", "n_ends")}
    parts |= {n: F.col(f"__f.l.{n}") for n in ("n_lines", "n_dup_lines")}
    parts |= {n: F.col(f"__f.{n}") for n in ("n_symbols", "n_letters", "n_upper")}
    return df.withColumns({n: c.cast("long") for n, c in parts.items()}).drop("__f")


def _vote(drop: Column, keep: Column) -> Column:
    return F.when(drop, -1).when(keep, 1).otherwise(0)


def _share(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))




def rules() -> dict[str, Column]:
    """Vote of every rule. Ratios of texts without words are 0; short texts abstain
    where a ratio says little."""
    n = F.col("n_words")
    length = _share("word_chars", "n_words")
    ends = _share("n_ends", "n_words")
    return {
        "symbols": _vote(_share("n_symbols", "n_words") > 0.3, _share("n_symbols", "n_words") <= 0.01),
        "letters": _vote(_share("n_letters", "word_chars") < 0.7, _share("n_letters", "word_chars") >= 0.85),
        "upper": _vote(_share("n_upper", "n_letters") > 0.4, _share("n_upper", "n_letters") < 0.15),
        "real_words": _vote(_share("n_real", "n_words") < 0.8, _share("n_real", "n_words") >= 0.98),
        "repeats": _vote(_share("n_repeat_words", "n_words") > 0.2, _share("n_repeat_words", "n_words") <= 0.02),
        "stutter": _vote(_share("n_stutter", "n_words") > 0.2, _share("n_stutter", "n_words") <= 0.02),
        "lines": _vote(_share("n_dup_lines", "n_lines") > 0.3, F.col("n_dup_lines") == 0),
        "sentences": _vote((n >= 40) & ((ends > 0.5) | (ends < 0.005)), ends.between(0.01, 0.3)),
        "word_length": _vote((n > 0) & ((length > 14) | (length < 2)), length.between(3, 9)),
    }


def _log_odds(votes: Column, prior: Column, good: Column, bad: Column) -> Column:
    """Log odds of a good text for an array of votes; ``good`` and ``bad`` hold the
    chances (drop, keep) of every rule."""

    def odds(v: Column, j: Column) -> Column:
        at = j * 2 + F.when(v > 0, 1).otherwise(0)
        return F.when(v == 0, 0.0).otherwise(F.ln(F.get(good, at)) - F.ln(F.get(bad, at)))

    each = F.transform(votes, odds)
    return F.aggregate(each, F.ln(prior) - F.ln(1 - prior), lambda s, x: s + x)


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> dict:
    """EM over counted patterns (votes array<int>, n long): prior, good, bad.

    The whole iteration is one expression over the sorted patterns, of which there
    are at most 3 ** rules however many documents there are.
    """
    rows = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("rows"))
    slots = F.sequence(F.lit(0), F.lit(2 * n_rules - 1))

    def guess(chances) -> Column:
        return F.array(*[F.lit(float(c)) for _ in range(n_rules) for c in chances])

    start = F.struct(
        F.lit(START).alias("prior"), guess(GUESS_GOOD).alias("good"), guess(GUESS_BAD).alias("bad")
    )

    def step(p: Column, _: Column) -> Column:
        scored = F.transform(
            F.col("rows"),
            lambda q: F.struct(
                q["votes"].alias("votes"),
                q["n"].alias("n"),
                (q["n"] * _sigmoid(_log_odds(q["votes"], p["prior"], p["good"], p["bad"]))).alias("g"),
            ),
        )

        def update(rows: Column) -> Column:
            def total(f) -> Column:
                return F.aggregate(rows, F.lit(0.0), lambda s, q: s + f(q))

            def chances(weight, first) -> Column:
                def votes_for(k: Column, *of: int) -> Column:
                    vote = F.floor(k / 2).cast("int")
                    return total(
                        lambda q: F.when(F.get(q["votes"], vote).isin(*of), weight(q)).otherwise(0.0)
                    )

                def chance(k: Column) -> Column:
                    own = F.when(k % 2 == 0, votes_for(k, -1)).otherwise(votes_for(k, 1))
                    share = (own + PSEUDO * F.get(guess(first), k)) / (votes_for(k, -1, 1) + PSEUDO)
                    return F.least(F.greatest(share, F.lit(RAREST)), F.lit(1 - RAREST))

                return F.transform(slots, chance)

            n, g = total(lambda q: q["n"]), total(lambda q: q["g"])
            return F.struct(
                ((g + PSEUDO * START) / (n + PSEUDO)).alias("prior"),
                chances(lambda q: q["g"], GUESS_GOOD).alias("good"),
                chances(lambda q: q["n"] - q["g"], GUESS_BAD).alias("bad"),
            )

        return bound(scored, update)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    r = rows.select(end.alias("p")).first().p
    return {"prior": r.prior, "good": list(r.good), "bad": list(r.bad)}


def posterior(votes: Column, model: dict) -> Column:
    """Probability that a text with these votes is good."""
    good, bad = (F.array(*[F.lit(x) for x in model[k]]) for k in ("good", "bad"))
    return _sigmoid(_log_odds(votes, F.lit(model["prior"]), good, bad))


def judged(
    df: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5
) -> tuple[DataFrame, dict]:
    """Rows with their figures, votes, posterior and verdict, and the fitted model.

    ``keep`` names the columns to carry (all but the text by default); columns with the
    names of figures are replaced. A text with fewer than 20 words, or with over 30 %
    of them in repeated windows, fails at base and is never kept. Null and empty texts
    fail. Repeated rows count as often as they occur. An empty table gives no rows and
    the first guesses as its model.
    """
    carried = [c for c in (keep if keep is not None else df.columns) if c != text or keep is not None]
    table = measured(df.select(*[F.col(c) for c in {*carried, text}]), text)
    figures = [c for c in table.columns if c not in {*carried, text} or c.startswith("n_") or c == "word_chars"]
    table = table.select(*dict.fromkeys([*carried, *figures])).withColumn("votes", F.array(*rules().values()))
    table = stored(table, "quality")
    patterns = table.groupBy("votes").agg(F.count("*").alias("n"))
    model = fit(patterns, len(rules()))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    table = table.withColumn("base_failed", failed).withColumn("posterior", posterior(F.col("votes"), model))
    return table.withColumn("kept", ~failed & (F.col("posterior") >= threshold)), model
