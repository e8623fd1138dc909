"""Quality rules by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule reads a few numbers of a text and votes good (1), bad (-1) or abstains (0). How often a rule is right is estimated
without labels: documents are counted by their votes (at most 3 ** len(RULES) = 2,187 rows, however many documents),
and expectation-maximisation over those counts finds, for each rule, how often it votes either way or abstains on good and on
bad texts. The posterior probability of "good" then decides, instead of all rules having to pass.

Only DataFrame functions touch the documents: one pass over the texts without any shuffle but that of the counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.text import put, whole

BLANK = r"[\x09-\x0D\x20]+"
#: Very common short words of English, French, German and Spanish.
COMMON = "the of and to in is that it for was on are with this be de la le et les des en que un une est dans par sur avec qui der die das und den von zu mit für ist nicht auf im el los las y por con para se no una su del".split()


def base_columns(text: Column) -> dict[str, Column]:
    """The plain numbers of a text that need no window of words."""
    words = F.array_remove(F.split(text, BLANK), "")
    return {"w": words, "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]"))}


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_common, n_ends, n_lines).

    Words in repeated windows: the hash of each window of three words, its lowest bits replaced by the position, is
    sorted; neighbours that agree in the other bits are equal windows (at least 40 bits of hash in any text of under
    16 million words, compared only within one text). Their sorted positions give the words that they cover. All of
    it is n log n in the length of the text.
    """
    body = whole(F.col("row")[text])
    out = docs.select(F.struct("*").alias("row"))
    out = out.select("row", *(c.alias(n) for n, c in base_columns(body).items()))
    out = out.select(
        "row", "w", F.size("w").alias("n"), F.char_length(F.bin(F.size("w").cast("long"))).alias("bits"), F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).alias("n_symbols"), F.char_length(F.regexp_replace(body, r"\P{Lu}+", "")).alias("n_upper"), F.char_length(F.regexp_replace(body, r"[^.!?]+", "")).alias("n_ends"),
        F.char_length(F.array_join("w", "")).alias("word_chars"), F.size(F.filter("w", lambda x: x.isin(COMMON))).alias("n_common"),
    )
    out = out.withColumn("low", F.expr("shiftleft(1L, bits) - 1"))
    numbers = ["row", "n", "n_lines", "n_dup_lines", "n_symbols", "n_upper", "n_ends", "word_chars", "n_common", "low"]
    marked = F.transform(F.sequence(F.lit(0), F.col("n") - 3), lambda i: F.xxhash64(F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]).bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long")))
    out = out.select(*numbers, F.when(F.col("n") >= 3, F.sort_array(marked)).alias("z"))

    def twin(i: Column) -> Column:
        def same(j: Column) -> Column:
            return F.coalesce(F.get("z", i).bitwiseXOR(F.get("z", j)).between(F.lit(0), F.col("low")), F.lit(False))

        return same(i - 1) | same(i + 1)

    at = F.transform(F.filter(F.sequence(F.lit(0), F.size("z") - 1), twin), lambda i: F.get("z", i).bitwiseAND(F.col("low")))
    out = out.select(*numbers, F.when(F.col("z").isNotNull(), F.sort_array(at)).alias("p"))
    start = F.struct(F.lit(-9).cast("long").alias("at"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("p", start, lambda a, x: F.struct(x.alias("at"), (a["n"] + F.least(F.lit(3).cast("long"), x - a["at"])).alias("n")), lambda a: a["n"])
    named = [F.col("n").cast("long").alias("n_words"), F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")]
    return out.select("row", *named, *(F.col(c).cast("long").alias(c) for c in numbers[2:-1]))


def ratio(name: str, by: str) -> Column:
    return F.col(name) / F.greatest(F.col(by), F.lit(1).cast("long"))


def votes() -> dict[str, Column]:
    """Each rule: 1, -1 or 0 from the features. The bounds are for running text of any of the languages. A rule that looks for
    one defect votes against or abstains: that a text lacks the defect says little for it."""

    def vote(bad: Column, good: Column | None = None) -> Column:
        against = F.when(bad, -1)
        return (against if good is None else against.when(good, 1)).otherwise(0)

    symbols, upper, common, repeat = ratio("n_symbols", "n_words"), ratio("n_upper", "word_chars"), ratio("n_common", "n_words"), ratio("n_repeat_words", "n_words")
    length, sentence, dup = ratio("word_chars", "n_words"), ratio("n_words", "n_ends"), ratio("n_dup_lines", "n_lines")
    return {
        "symbols": vote(symbols > 0.2),
        "capitals": vote(upper > 0.3),
        "common_words": vote(common < 0.02, common > 0.08),
        "repetition": vote(repeat > 0.4),
        "word_length": vote((length < 2) | (length > 12)),
        "sentences": vote((sentence < 2) | (F.col("n_ends") == 0), sentence.between(3, 60)),
        "lines": vote(dup > 0.4),
    }


RULES = tuple(["symbols", "capitals", "common_words", "repetition", "word_length", "sentences", "lines"])


#: How often a rule votes 1, abstains and votes -1 on good texts before anything is known; on bad ones the other way round.
FIRST = {1: 0.45, 0: 0.45, -1: 0.1}


@dataclass(frozen=True)
class Model:
    """prior: share of good documents; good[rule][vote], bad[rule][vote]: how often a rule votes so on good and on bad ones
    (of those, a rule's accuracies are good[rule][1] and bad[rule][-1])."""

    prior: float
    good: dict[str, dict[int, float]]
    bad: dict[str, dict[int, float]]

    def weight(self, rule: str, vote: int) -> float:
        """What a vote adds to the log odds of good; a vote never counts for the other side."""
        w = math.log(self.good[rule][vote] / self.bad[rule][vote])
        return max(w, 0.0) if vote > 0 else min(w, 0.0) if vote < 0 else w

    def posterior(self) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule in RULES:
            odds = odds + F.when(F.col(rule) > 0, self.weight(rule, 1)).when(F.col(rule) < 0, self.weight(rule, -1)).otherwise(self.weight(rule, 0))
        return 1 / (1 + F.exp(-odds))


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 60) -> Model:
    """Expectation-maximisation over documents counted by their votes. It starts from FIRST and two good texts of three,
    and keeps five documents of either kind that vote like that, so an empty table gives these back."""
    turned = {v: FIRST[-v] for v in FIRST}
    model = Model(2 / 3, dict.fromkeys(RULES, FIRST), dict.fromkeys(RULES, turned))
    for _ in range(rounds):
        good, bad = ({r: {v: 5 * p for v, p in start.items()} for r in RULES} for start in (FIRST, turned))
        sure, every = 2.0, 3.0
        odds_of = {r: {v: model.weight(r, v) for v in FIRST} for r in RULES}
        for pattern, n in counts.items():
            odds = math.log(model.prior / (1 - model.prior)) + sum(odds_of[r][v] for r, v in zip(RULES, pattern, strict=True))
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
            sure, every = sure + n * p, every + n
            for r, v in zip(RULES, pattern, strict=True):
                good[r][v] += n * p
                bad[r][v] += n * (1 - p)
        share = [{r: {v: x / sum(of[r].values()) for v, x in of[r].items()} for r in RULES} for of in (good, bad)]
        model = Model(min(0.99, max(0.01, sure / every)), *share)
    return model


def fit(scored: DataFrame) -> Model:
    """The model of all documents in a frame of features; only the counts by votes come to the driver."""
    rules = votes()
    rows = scored.select(*(rules[r].alias(r) for r in RULES)).groupBy(*RULES).count().collect()
    return estimate({tuple(row[r] for r in RULES): row["count"] for row in rows})


def judge(scored: DataFrame, model: Model) -> DataFrame:
    """The features with the votes, quality (the posterior probability of good), base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = scored.withColumns(votes()).withColumn("quality", model.posterior())
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= 0.5))


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Defined cases: a null or empty text has no words and fails the base rules, as does any of under 50 words; repeated
    rows are judged alike; an empty table gives an empty one; other columns, whatever their names, are carried along untouched.
    """
    scored = features(docs, text)
    judged = judge(scored, fit(scored))
    # the observed counts also keep the filter where it is: pushed below, it would work out the lists of words again for each of their elements
    judged = judged.observe("quality_rules", F.count("*").alias("seen"), F.count_if("kept").alias("kept"))
    return judged.where("kept").select(*put(docs, "row"))
