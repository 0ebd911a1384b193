"""Transcript parsing with a hidden Markov model, and canonical turn rendering.

Each line of a transcript is emitted by a hidden state: the first or a later
line of a turn of one role. Its features are the speaker marker it starts with,
whether a blank line stands before it, its end mark and its length. Transition
and emission counts come from transcripts whose roles are known, but for a third
of the conversations, which is held out; Viterbi then recovers the states of
all, and runs of lines become turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import save
from pelagia.llm.words import small_batches

ROLES = ("system", "user", "assistant")
STATES = tuple((role, first) for role in ROLES for first in (True, False))
#: Speaker markers, by role.
MARKERS = {"system": ("system", "instructions"), "user": ("user", "human", "q", "question", "me"), "assistant": ("assistant", "ai", "bot", "a", "answer")}
_ROLE_OF = {m: role for role, marks in MARKERS.items() for m in marks}
_MARK = re.compile(r"^\s*(?:[#*>\[<|]+\s*)?([A-Za-z]+)\s*(?:[\]>|*]+)?\s*:\s?", re.ASCII)
#: Characters of a blank line, here and in SQL.
BLANK = " \t\r\f\v"
#: Turns of one conversation that make one transcript.
PART = 256


def marker(line: str) -> tuple[str, str]:
    """(role named by the marker or 'none', the line without it)."""
    found = _MARK.match(line)
    role = _ROLE_OF.get(found[1].lower()) if found else None
    return (role, line[found.end() :]) if role else ("none", line)


def features(line: str, blank_before: bool) -> tuple[str, str, str, str]:
    role, rest = marker(line)
    size = len(rest)
    return ("m" + role, "b" + str(int(blank_before)), "e" + (rest.rstrip()[-1:] if rest.rstrip()[-1:] in "?:!" else "."), "l" + str(0 if size < 40 else 1 if size < 160 else 2))


def _lines(text: str) -> list[tuple[str, bool]]:
    """Non-blank lines with whether a blank line stands before."""
    out, blank = [], True
    for line in text.split("\n"):
        if line.strip(BLANK):
            out.append((line, blank))
            blank = False
        else:
            blank = True
    return out


class Model:
    """Log probabilities from counts, with add-one smoothing."""

    def __init__(self, starts: dict, moves: dict, emits: dict):
        n = len(STATES)
        self.start = [log((starts.get(s, 0) + 1) / (sum(starts.values()) + n)) for s in range(n)]
        self.move = [[log((moves.get((s, t), 0) + 1) / (sum(moves.get((s, u), 0) for u in range(n)) + n)) for t in range(n)] for s in range(n)]
        kinds = {"m": 4, "b": 2, "e": 4, "l": 3}
        totals = {(s, k): sum(c for (u, f), c in emits.items() if u == s and f[0] == k) for s in range(n) for k in kinds}
        self.emits, self.totals, self.kinds = emits, totals, kinds

    def emission(self, state: int, feats: tuple[str, ...]) -> float:
        return sum(log((self.emits.get((state, f), 0) + 0.5) / (self.totals[state, f[0]] + 0.5 * self.kinds[f[0]])) for f in feats)

    def viterbi(self, lines: list[tuple[str, ...]]) -> list[int]:
        """The likeliest states; of equal paths, the one of smaller state numbers."""
        if not lines:
            return []
        n, cache, back = len(STATES), {}, []
        score = None
        for feats in lines:
            own = cache.setdefault(feats, [self.emission(s, feats) for s in range(n)])
            if score is None:
                score = [self.start[s] + own[s] for s in range(n)]
                continue
            best = [max(range(n), key=lambda s, t=t: score[s] + self.move[s][t]) for t in range(n)]
            score = [score[best[t]] + self.move[best[t]][t] + own[t] for t in range(n)]
            back.append(best)
        path = [max(range(n), key=lambda s: score[s])]
        for best in reversed(back):
            path.append(best[path[-1]])
        return path[::-1]


def parse(text: str, model: Model) -> list[tuple[str, str]]:
    """(role, text) turns of one transcript; markers are taken off first lines, blank lines between turns belong to none."""
    lines = _lines(text)
    states = iter(model.viterbi([features(*x) for x in lines]))
    turns: list[tuple[str, list[str]]] = []
    gap: list[str] = []
    for line in text.split("\n"):
        if not line.strip(BLANK):
            gap.append(line)
            continue
        role, first = STATES[next(states)]
        if first or not turns or turns[-1][0] != role:
            turns.append((role, []))
            line, gap = marker(line)[1], []
        turns[-1][1].extend([*gap, line])
        gap = []
    return [(role, "\n".join(own)) for role, own in turns]


def render(turns: list[tuple[str, str]]) -> str:
    """Canonical turns: <|role|>, newline, text, newline, <|end|>."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def fit(transcripts: DataFrame) -> Model:
    """Counts over all transcripts (transcript, roles array, sizes array of lines per turn,
    new array: false for further copies of a row, which teach nothing)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tally: dict[tuple[int, int, str], int] = {}
            for text, roles, sizes, new in zip(b["transcript"], b["roles"], b["sizes"], b["new"], strict=True):
                states = [(STATES.index((r, k == 0)), once) for r, n, once in zip(roles, sizes, new, strict=True) for k in range(n)]
                before = -1
                for (s, once), line in zip(states, _lines(text), strict=True):
                    if not once:
                        continue
                    keys = [(before, s, ""), *((s, s, f) for f in features(*line))]
                    before = s
                    for key in keys:
                        tally[key] = tally.get(key, 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in tally.items()], columns=["a", "b", "f", "n"])

    # at most states * (states + features) rows
    rows = transcripts.select("transcript", "roles", "sizes", "new").mapInPandas(count, "a int, b int, f string, n long").groupBy("a", "b", "f").agg(F.sum("n").alias("n")).collect()
    starts = {r.b: r.n for r in rows if r.a < 0}
    moves = {(r.a, r.b): r.n for r in rows if r.a >= 0 and not r.f}
    return Model(starts, moves, {(r.b, r.f): r.n for r in rows if r.f})


def transcripts(turns: DataFrame) -> DataFrame:
    """Raw transcripts from (conv_id, turn, role, text), in four marker styles.

    A conversation is cut every ``PART`` turns, so no row grows with it; rows
    repeated under one turn follow each other by role and text, each as often as
    it is given. A part of more than ``PART`` rows is cut at every turn, and a
    turn of more, whose rows have no order, by their hash; ``part`` and ``spill``
    keep the order of turns. Leading
    blank lines and trailing blanks of a text go; all else of it stays. Turns without a non-blank line, with a
    null text, or of an unknown role are no turns. One style leaves the user's
    turns unmarked after the first.
    """
    # blank lines and indentation inside a turn stay
    text = F.rtrim(F.regexp_replace("text", r"^(?:[ \t\r\f\x0B]*+\n)*+", ""), F.lit(BLANK + "\n"))
    rows = turns.select("conv_id", "turn", "role", text.alias("text")).where(F.col("role").isin(*ROLES) & (F.col("text") != ""))
    # equal rows are counted until they have their parts: a turn can repeat without bound
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    rows = rows.withColumn("part", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / PART))
    many = rows.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.sum("times").alias("own"))
    rows = rows.join(many, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    rows = rows.drop("c", "p")
    long = rows.where(F.col("own") > PART).groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("u")).agg(F.ceil(F.sum("times") / PART).alias("cuts"))
    rows = rows.join(long, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("u")), "left").drop("c", "u")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    turn = F.pmod(F.coalesce("turn", F.lit(-1)), F.lit(PART)).cast("long") + 1
    rows = rows.withColumn("spill", F.when(F.col("cuts").isNotNull(), turn * (1 << 40) + F.pmod(F.xxhash64("role", "text", "copy"), F.col("cuts"))).otherwise(F.lit(0).cast("long")))
    style = F.pmod(F.xxhash64(F.col("conv_id").cast("string")), F.lit(4))
    named = F.create_map(*[F.lit(x) for k, names in enumerate((("System: ", "User: ", "Assistant: "), ("System: ", "Human: ", "AI: "), ("## Instructions: ", "Q: ", "A: "), ("System: ", "User: ", "Assistant: "))) for r, m in zip(ROLES, names, strict=True) for x in (f"{k}{r}", m)])
    bare = (F.col("style") == 3) & (F.col("role") == "user") & (F.col("turn") > 1)
    rows = rows.withColumn("style", style).withColumn("mark", F.when(bare, "").otherwise(named[F.concat(F.col("style").cast("string"), F.col("role"))]))
    line = F.struct("turn", "role", "text", "copy", "mark")
    groups = rows.groupBy("conv_id", "part", "spill").agg(F.sort_array(F.collect_list(line)).alias("t"), F.first("style").alias("style"))
    gap = F.when(F.col("style") == 1, "\n").otherwise("\n\n")
    return groups.select(
        "conv_id", "part", "spill",
        F.transform("t", lambda x: F.concat(x["mark"], x["text"])).alias("joined"), gap.alias("gap"),
        F.transform("t", lambda x: x["role"]).alias("roles"), F.transform("t", lambda x: x["copy"] == 1).alias("new"),
        F.transform("t", lambda x: F.size(F.filter(F.split(x["text"], "\n"), lambda y: y.rlike(r"[^ \t\r\f\x0B]")))).alias("sizes"),
    ).select("conv_id", "part", "spill", F.expr("array_join(joined, gap)").alias("transcript"), "roles", "sizes", "new")


def format_chats(raw: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns, n_turns, roles_found, rendered for every row of raw (transcript, ...)."""
    schema = ", ".join(f"{c} {raw.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            turns = [parse(t or "", model) for t in b["transcript"]]
            out = b[columns].copy()
            out["n_turns"] = [len(t) for t in turns]
            out["roles_found"] = [[r for r, _ in t] for t in turns]
            out["rendered"] = [render(t) for t in turns]
            yield out

    return raw.select("transcript", *columns).mapInPandas(run, f"{schema}, n_turns long, roles_found array<string>, rendered string")


def held_out() -> Column:
    """Conversations that teach the model nothing; a null conv_id is not held out."""
    return F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 3 == 1, F.lit(False))


def recover_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, spill, held_out, n_turns, n_given, same_roles, rendered of every conversation.

    Transcripts are written from the turns, the model is fitted on those not
    held out and the roles of all are recovered from the bare lines. Defined
    cases: see ``transcripts``; a conversation without usable turns has one row
    of no turns and an empty text; a null conv_id is a conversation of its own;
    an empty table gives an empty result; extra columns are ignored.
    """
    small_batches(conversations.sparkSession)
    raw = save(transcripts(conversations))
    model = fit(raw.where(~held_out()))
    out = format_chats(raw, model, ["conv_id", "part", "spill", "roles"])
    out = out.select("conv_id", "part", "spill", held_out().alias("held_out"), "n_turns", F.size("roles").cast("long").alias("n_given"), (F.col("roles") == F.col("roles_found")).alias("same_roles"), "rendered")
    some = raw.select(F.col("conv_id").alias("c")).distinct()
    none = conversations.select("conv_id").distinct().join(some, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti")
    zero = F.lit(0).cast("long")
    return out.unionByName(none.select("conv_id", zero.alias("part"), zero.alias("spill"), held_out().alias("held_out"), zero.alias("n_turns"), zero.alias("n_given"), F.lit(True).alias("same_roles"), F.lit("").alias("rendered")))
