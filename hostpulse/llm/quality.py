"""Quality rules as a ledger: every rule is evaluated once, and kept as one failure bit beside its measurements.

Which rules count is decided later, by a policy: a named, versioned mask over the bits. Changing a policy, or asking
what each rule costs, is bitwise work on the ledger and never touches a text again.

Defined cases: a NULL or empty text has zero of everything and fails `few_words`; repeated rows get equal rows; an empty
table gives an empty ledger; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hostpulse.llm.common import SPACE_RUN

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rule:
    """A bit and the condition, over measurement columns, under which a document fails."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: Bits are never reused: a stored ledger stays readable when rules are added.
RULES = [
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "capitals", "100 * n_capitals > 60 * word_chars"),
]
BASE = RULES[0].mask | RULES[1].mask
#: Versioned policies: the rules that reject.
POLICIES = {"v1": BASE | RULES[2].mask, "v2": sum(r.mask for r in RULES)}
CURRENT = "v2"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]


def _covered(windows: Column) -> Column:
    """First words of repeated windows in order, from sorted (hash, position) pairs; the hash keeps all its 64 bits."""
    same = lambda x, y: x["hash"] == y["hash"]
    away = F.lit(False)
    repeated = F.filter(
        windows, lambda x, k: F.coalesce(same(x, F.get(windows, k - 1)), away) | F.coalesce(same(x, F.get(windows, k + 1)), away)
    )
    return F.sort_array(F.transform(repeated, lambda x: x["at"]))


def measure(docs: DataFrame, carry: list[str] = []) -> DataFrame:
    """One pass without a shuffle: a document's measurements beside its id and the columns to carry along."""
    words = F.array_remove(F.split("_text", SPACE_RUN), "")
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    zero = F.lit(0).cast("long")
    step = docs.select("doc_id", *carry, F.coalesce("text", F.lit("")).alias("_text"))
    step = step.select("doc_id", *carry, "_text", words.alias("_words"), lines.alias("_lines"))
    step = step.select(
        "doc_id",
        *carry,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", _SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[A-Z]+", ""))).cast("long").alias("n_capitals"),
    )
    hashed = lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(3)))
    windows = F.when(
        F.col("n_words") >= 3,
        F.sort_array(F.transform(
            F.sequence(zero, F.col("n_words") - 3), lambda i: F.struct(hashed(i).alias("hash"), i.alias("at"))
        )),
    )
    step = step.withColumn("_windows", windows).drop("_words")
    step = step.withColumn("_at", _covered(F.col("_windows"))).drop("_windows")
    gained = F.transform("_at", lambda x, k: F.coalesce(F.least(F.get("_at", k + 1) - x, F.lit(3)), F.lit(3)).cast("long"))
    covered = F.coalesce(F.aggregate(gained, zero, lambda total, x: total + x), zero)
    return step.withColumn("n_repeat_words", covered).select("doc_id", *carry, *MEASURES)


def ledger(docs: DataFrame, rules: list[Rule] = RULES, carry: list[str] = []) -> DataFrame:
    """doc_id, all measurements, and `fail_bits`: the mask of failed rules."""
    bits = [F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(0).cast("long") for r in rules]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, carry).withColumn("fail_bits", total)


def passes(policy: str = CURRENT) -> Column:
    """Whether a ledger row has none of the policy's failures."""
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(kept: DataFrame, policy: str = CURRENT, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: failures, documents that only this rule rejects, documents kept without it.

    The ledger is first counted by its bits (at most one row per combination of rules), then compared bitwise.
    """
    mask = POLICIES[policy]
    combos = kept.select(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).groupBy("bits").count()
    named = F.explode(F.array(*(
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask")) for r in rules if r.mask & mask
    ))).alias("r")
    rows = combos.select("bits", "count", named).select("bits", "count", "r.rule", "r.mask")
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("mask")))
    hit = F.col("bits").bitwiseAND(F.col("mask")) != 0
    add = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0))
    return rows.groupBy("rule").agg(
        add(hit).alias("failed"), add(hit & (rest == 0)).alias("only_this"), add(rest == 0).alias("kept_without")
    )


def reject(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass, with their own columns: a filter over the same row, no join and no shuffle.

    The observed count stands between measurements and filter: pushed below them, the filter would evaluate them again and again.
    """
    row = docs.select(F.col("doc_id"), F.col("text"), F.struct(*docs.columns).alias("_row"))
    counted = ledger(row, carry=["_row"]).observe(Observation(), F.count(F.lit(1)).alias("documents"))
    return counted.where(passes(policy)).select("_row.*")
