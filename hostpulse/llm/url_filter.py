"""URL filters: allow and block rules first, then words inside host names.

Host labels such as "freecasinobets" are split into words by a unigram Viterbi search over word counts of the pages themselves;
segmented host and path words go to a multinomial naive Bayes model with two classes. The model learns from all pages: a page is
an example of `block` if its segmented host or path holds a word of the seed list, else of `allow`.

Defined cases: a NULL url or one without "://" has empty host and path, no rule, and is judged by the prior alone; repeated rows
get equal rows; without pages there are no rows; a class without examples is never predicted; columns other than page_id, url and
html are ignored. NULL html adds no words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hostpulse.operators.quantiles import quantiles
from hostpulse.session import materialise

#: (verdict, host, path): a rule fits its host and all hosts below it, if the path starts with the rule's.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Words that mark a page as an example of `block`.
SEEDS = [
    "adult", "bet", "bets", "betting", "casino", "cheap", "dating", "escort", "gambling", "jackpot", "lottery", "pills",
    "pharma", "poker", "porn", "replica", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "xxx", "ads",
]
#: The shortest and longest word that the segmenter's dictionary takes from the pages.
SHORTEST, LONGEST = 2, 20
#: Starts of a run whose substrings are gathered and looked up together.
STRETCH = 5_000
_LETTERS = re.compile(r"[^\W\d_]+")


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first :// up to the next / ? # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or NULL."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    found = F.lit(None)
    for verdict, name, start in reversed(longest):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


class Segmenter:
    """Most probable split of a run of letters into known words; unknown stretches cost more the longer they are.

    `total` is the sum of all counts, if `counts` has only the words that a run can hold.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0

    def split(self, run: str) -> list[str]:
        search = Search(self.unknown)
        search.advance(run, len(run), lambda word, at: self.cost.get(word))
        return search.words(run)


class Search:
    """The Viterbi search over a run that comes in stretches: costs are kept for the last LONGEST places, and one back step a place."""

    def __init__(self, unknown: float):
        self.unknown = unknown
        self.at, self.best, self.back = 0, [0.0], [0]

    def advance(self, ahead: str, places: int, cost: Callable[[str, int], float | None]) -> None:
        """Go on by `places` starts; `ahead` has the letters from the first of them, LONGEST - 1 beyond the last if the run has them."""
        best = self.best + [math.inf] * (len(ahead) + 1 - len(self.best))
        self.back += [0] * (self.at + len(ahead) + 1 - len(self.back))
        for start in range(places):
            for end in range(start + 1, min(start + LONGEST, len(ahead)) + 1):
                known = cost(ahead[start:end], start)
                there = best[start] + (self.unknown + 3.0 * (end - start) if known is None else known)
                if there < best[end]:
                    best[end], self.back[self.at + end] = there, self.at + start
        self.at, self.best = self.at + places, best[places:]

    def words(self, run: str) -> list[str]:
        words, end = [], len(run)
        while end:
            words.append(run[self.back[end]:end])
            end = self.back[end]
        return words[::-1]


@dataclass(frozen=True)
class UrlModel:
    """Dictionary counts, and per token the log odds of block against allow.

    Both are written tables of any size, (word, count) and (token, odds), or small dicts.
    """

    words: DataFrame | dict[str, int]
    prior: float
    odds: DataFrame | dict[str, float]
    unseen: float


def _table(spark: SparkSession, given: DataFrame | dict, schema: str) -> DataFrame:
    return spark.createDataFrame(list(given.items()), schema) if isinstance(given, dict) else given


def word_counts(pages: DataFrame, seeds: list[str] = SEEDS) -> DataFrame:
    """All words of the pages' html with their counts; seed words count at least as much as the median word."""
    letters = F.explode(F.regexp_extract_all(F.lower(F.regexp_replace("html", "<[^<>]*>", " ")), F.lit(r"(\p{L}+)"), F.lit(1)))
    words = pages.select(letters.alias("word")).where(F.length("word").between(SHORTEST, LONGEST))
    counts = materialise(words.groupBy("word").count(), "page-words")
    n = counts.count()
    # The quantile of this rank is the word's own count, without interpolation.
    usual = round(quantiles(counts, {"count": [n // 2 / max(n - 1, 1)]})["count"][0]) if n else 1
    found = {r["word"]: r["count"] for r in counts.where(F.col("word").isin(seeds)).collect()}
    marks = {w: max(found.get(w, 0), usual) for w in seeds}
    return counts.where(~F.col("word").isin(seeds)).unionByName(_table(pages.sparkSession, marks, "word string, count long"))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of letters of the host, marked, and of the lower-cased path."""
    for batch in batches:
        yield batch.assign(runs=[
            [*(f"h:{r}" for r in _LETTERS.findall(h)), *(f"p:{r}" for r in _LETTERS.findall(p.lower()))]
            for h, p in zip(batch["host"], batch["path"], strict=True)
        ])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, nth, ahead, words): a run by stretches of its starts, with the letters a word from there can reach, and its substrings that
    a dictionary may hold."""
    rows, held = [], 0

    def gathered() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        types = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "nth", "ahead", "words"])

    for batch in batches:
        for key, run in zip(batch["id"].to_pylist(), batch["run"].to_pylist()):
            for nth, at in enumerate(range(0, len(run), STRETCH)):
                ahead = run[at:at + STRETCH + LONGEST - 1]
                found = {
                    ahead[i:j] for i in range(min(STRETCH, len(ahead))) for j in range(i + SHORTEST, min(i + LONGEST, len(ahead)) + 1)
                }
                rows.append((key, nth, ahead, list(found)))
                held += len(found)
                if held >= STRETCH:
                    yield gathered()
                    rows, held = [], 0
    yield gathered()


def _splits(total: int):
    """Words of each run from its stretches in order, with the counts of the words that each stretch holds."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown, run, key, search = math.log(total + 1) + 2.0, [], None, None
        for batch in batches:
            done = []
            for own, ahead, known in zip(*(batch[c].to_pylist() for c in ("id", "ahead", "known"))):
                if own != key:
                    if search:
                        done.append((key, search.words("".join(run))))
                    key, run, search = own, [], Search(unknown)
                costs = {r["word"]: -math.log(r["count"] / (total + 1)) for r in known}
                search.advance(ahead, min(STRETCH, len(ahead)), lambda word, _: costs.get(word))
                run.append(ahead[:STRETCH])
            yield _split_batch(done)
        yield _split_batch([(key, search.words("".join(run)))] if search else [])

    return split


def _split_batch(done: list[tuple[int, list[str]]]) -> pa.RecordBatch:
    ids, words = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.string()))], ["id", "words"])


def segmented(pages: DataFrame, words: DataFrame | dict[str, int]) -> DataFrame:
    """The distinct places of the pages, written: place, host, path, count, tokens.

    Every distinct run of letters is split once, with the counts of all dictionary words that it holds; a long run by stretches.
    """
    words = _table(pages.sparkSession, words, "word string, count long")
    total = words.agg(F.sum("count")).first()[0] or 0
    parts = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    schema = "host string, path string, count long, runs array<string>"
    places = parts.groupBy("host", "path").count().mapInPandas(_runs, schema)
    places = materialise(places.withColumn("place", F.monotonically_increasing_id()), "url-places")
    each = places.select("place", F.posexplode("runs").alias("at", "marked"))
    each = each.select("place", "at", F.substring("marked", 1, 2).alias("side"), F.expr("substring(marked, 3)").alias("run"))
    runs = materialise(each.select("run").distinct().withColumn("id", F.monotonically_increasing_id()), "url-run-ids")
    stretches = materialise(runs.mapInArrow(_stretches, "id long, nth int, ahead string, words array<string>"), "url-stretches")
    held = stretches.select("id", "nth", F.explode("words").alias("word")).join(words, "word")
    known = held.groupBy("id", "nth").agg(F.collect_list(F.struct("word", "count")).alias("known"))
    ordered = stretches.drop("words").join(known, ["id", "nth"], "left").withColumn(
        "known", F.coalesce("known", F.array().cast("array<struct<word:string,count:bigint>>"))
    ).repartition("id").sortWithinPartitions("id", "nth")
    splits = ordered.mapInArrow(_splits(total), "id long, words array<string>").join(runs, "id").drop("id")
    splits = materialise(splits, "url-runs")
    found = each.join(splits, "run").select("place", F.struct("at", "side", "words").alias("part"))
    found = found.groupBy("place").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    tokens = F.flatten(F.transform("parts", lambda p: F.transform(p["words"], lambda w: F.concat(p["side"], w))))
    found = places.drop("runs").join(found, "place", "left")  # a place without letters has no parts
    tokens = F.coalesce(tokens, F.array().cast("array<string>"))
    return materialise(found.select("place", "host", "path", "count", tokens.alias("tokens")), "url-segmented")


def learn(pages: DataFrame, seeds: list[str] = SEEDS) -> tuple[UrlModel, DataFrame]:
    """The model, and the segmented places of the pages it learned from.

    The tokens of all pages are counted by class, and every token has its own odds; only totals come to the driver.
    """
    words = word_counts(pages, seeds)
    places = segmented(pages, words)
    marks = F.array(*(F.lit(f"{side}:{w}") for w in seeds for side in "hp"))
    marked = places.select("count", "tokens", F.arrays_overlap("tokens", marks).alias("block"))
    each = marked.select(F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token"), "block", "count")
    counts = each.groupBy("token").agg(
        F.sum(F.when(F.col("block"), F.col("count")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("block"), 0).otherwise(F.col("count"))).alias("a"),
    )
    counts = materialise(counts, "url-tokens")
    pages_of = counts.where("token = ''").first() or {"a": 0, "b": 0}
    if not pages_of["a"] or not pages_of["b"]:
        return UrlModel(words, -math.inf if not pages_of["b"] else math.inf, {}, 0.0), places
    counts = counts.where("token <> ''")
    total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("n")).first()
    a, b, v = total["a"] or 0, total["b"] or 0, total["n"] + 1
    odds = counts.select("token", (F.log((F.col("b") + 1) / (b + v)) - F.log((F.col("a") + 1) / (a + v))).alias("odds"))
    return UrlModel(words, math.log(pages_of["b"] / pages_of["a"]), odds, math.log((a + v) / (b + v))), places


def fit(pages: DataFrame, seeds: list[str] = SEEDS) -> UrlModel:
    return learn(pages, seeds)[0]


def _scored(places: DataFrame, model: UrlModel) -> DataFrame:
    """host, path, tokens and score of written places: their tokens meet the odds by a join and are added up in their order."""
    odds = _table(places.sparkSession, model.odds, "token string, odds double")
    each = places.select("place", F.posexplode("tokens").alias("at", "token")).join(odds, "token", "left")
    each = each.select("place", F.struct("at", F.coalesce("odds", F.lit(model.unseen)).alias("odds")).alias("step"))
    steps = each.groupBy("place").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    evidence = F.aggregate("steps", F.lit(0.0), lambda total, step: total + step["odds"])
    found = places.join(steps, "place", "left")  # a place without tokens has no steps
    return found.select("host", "path", "tokens", (F.lit(model.prior) + F.coalesce(evidence, F.lit(0.0))).alias("score"))


def judge(
    pages: DataFrame, model: UrlModel, rules: list[tuple[str, str, str]] = RULES, places: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and what the method saw: tokens and the log odds of block.

    `places` are the segmented places of the same pages, if they are there already.
    """
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    places = segmented(pages, model.words) if places is None else places
    scored = parts.join(_scored(places, model), ["host", "path"])
    ruled = scored.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return ruled.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", method).alias("verdict"), "tokens", "score",
    )
