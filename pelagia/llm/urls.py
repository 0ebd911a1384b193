"""URL filter: rules on host and path, else segmented words under naive Bayes.

A name such as ``cheappills`` in host or path is split by Viterbi over unigram
word costs; multinomial naive Bayes, trained on the labelled names below, then
scores the words. The unigram costs are counted over the words of all pages.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import save

#: Fixed values: (host, path prefix, verdict). The longest fitting rule wins.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: The labelled training names.
UNWANTED = (
    "spam farm", "cheap pills", "casino win", "free bets", "ads track", "online casino bonus", "win free cash", "cheap loans online",
    "best pills shop", "free spins slots", "poker bets win", "adult chat cams", "adult video", "hot singles dating", "payday loans fast", "replica watches cheap",
    "click ads banner", "track pixel ads", "spam mail blast", "viagra pills online", "lottery prize winner", "betting odds bonus", "link farm seo",
    "popup ads server", "torrent crack keygen", "porn tube free", "sex cams live", "bitcoin double cash", "miracle weight loss pills",
)
WANTED = (
    "city museum", "state university", "public library", "daily news", "weather service", "science journal", "history archive", "open source docs",
    "world health report", "school math lessons", "music festival guide", "garden plants", "cooking recipes kitchen", "national park trails",
    "local government office", "travel guide europe", "film review magazine", "language learning course", "research institute physics", "art gallery online",
    "football club news", "book review", "bird watching club", "software developer forum", "river water project", "hospital care center", "train travel times", "encyclopedia article", "help center support",
)
#: Words of the unigram model sent to every task at most: the most frequent ones; all others cost what unknown words do.
VOCABULARY = 50_000
#: Share of the labelled names' words in the unigram model, so that all of them are known.
LISTED = 0.01
#: A smaller corpus counts as one of so many words.
LEAST_WORDS = 1_000_000


def _bag(names: tuple[str, ...]) -> dict[str, int]:
    bag: dict[str, int] = {}
    for word in " ".join(names).split():
        bag[word] = bag.get(word, 0) + 1
    return bag


_BAD, _GOOD = _bag(UNWANTED), _bag(WANTED)
_LISTED = {w: _BAD.get(w, 0) + _GOOD.get(w, 0) for w in _BAD | _GOOD}
_BAD_SUM, _GOOD_SUM = sum(_BAD.values()), sum(_GOOD.values())


def odds(words: Iterable[str]) -> float:
    """Log odds that these words are unwanted; words outside the labelled names say nothing."""
    out, size = log(len(UNWANTED) / len(WANTED)), len(_LISTED)
    for word in words:
        if word in _LISTED:
            out += log((_BAD.get(word, 0) + 1) / (_BAD_SUM + size)) - log((_GOOD.get(word, 0) + 1) / (_GOOD_SUM + size))
    return out


def _names(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


class Segmenter:
    """Splits names into words; ``counts`` are of a corpus of ``total`` words."""

    def __init__(self, counts: dict[str, int], total: int):
        total, listed = max(total, LEAST_WORDS), sum(_LISTED.values())
        self.cost = {w: -log((1 - LISTED) * counts.get(w, 0) / total + LISTED * _LISTED.get(w, 0) / listed) for w in counts.keys() | _LISTED.keys()}
        self.longest = max(map(len, self.cost))
        #: An unknown word of n letters: ten of all words, shared among 10 ** n spellings.
        self.base, self.letter = log(total / 10), log(10)
        self.segment = lru_cache(maxsize=65536)(self._segment)

    def _segment(self, name: str) -> tuple[str, ...]:
        """The cheapest split; equal costs take the one found first, from the left."""
        best, run = [(0.0, 0)], [(float("inf"), 0)]
        for end in range(1, len(name) + 1):
            run.append(min((run[-1][0] + self.letter, run[-1][1]), (best[-1][0] + self.base + self.letter, end - 1)))
            choice = run[-1]
            for start in range(max(0, end - self.longest), end):
                cost = self.cost.get(name[start:end])
                if cost is not None:
                    choice = min(choice, (best[start][0] + cost, start))
            best.append(choice)
        words, end = [], len(name)
        while end:
            start = best[end][1]
            words.append(name[start:end])
            end = start
        return tuple(reversed(words))

    def unwanted(self, host: str, path: str) -> bool:
        return odds(w for name in _names(host) + _names(path) for w in self.segment(name)) > 0


def unigrams(pages: DataFrame) -> tuple[dict[str, int], int]:
    """Counts of the ``VOCABULARY`` most frequent words of the pages' text, and the number of all its words."""
    if "html" not in pages.columns:
        return {}, 0
    text = F.lower(F.regexp_replace("html", r"(?s)<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counts = save(words.groupBy("word").agg(F.count("*").alias("n")).where(F.length("word") <= 30).withColumn("level", F.floor(F.log2("n") * 8).cast("int")))
    # a few hundred levels of frequency; the lowest that still leaves at most VOCABULARY words
    levels = {r.level: r for r in counts.groupBy("level").agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()}
    least, known = max(levels, default=0) + 1, 0
    for level in sorted(levels, reverse=True):
        known += levels[level].words
        if known > VOCABULARY:
            break
        least = level
    return {r.word: r.n for r in counts.where(F.col("level") >= least).collect()}, sum(r.n for r in levels.values())


def judge_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url).

    The unigram model is counted over the pages' ``html``, where that is given.
    Defined cases: a null url or one without ``://`` has an empty host and path
    and is allowed; null html has no words; rows repeat as given; a null page_id is kept; other columns
    are ignored.
    """
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise("")
    parts = pages.select("page_id", rest.alias("rest"))
    raw = F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1)
    parts = parts.select(
        "page_id",
        F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, said = F.when(fits, host + path).otherwise(rule), F.when(fits, verdict).otherwise(said)
    judged = parts.withColumns({"rule": rule, "said": said})
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, said string, method string"
    sent = pages.sparkSession.sparkContext.broadcast(unigrams(pages))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = Segmenter(*sent.value)
        for b in batches:
            b["method"] = ["block" if split.unwanted(h, p) else "allow" for h, p in zip(b["host"], b["path"], strict=True)]
            yield b

    return judged.mapInPandas(judge, schema).select("page_id", "host", "path", "rule", F.coalesce("said", "method").alias("verdict"))
