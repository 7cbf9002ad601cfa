"""Transcript parsing: a hidden Markov model recovers who speaks on each line, then turns are rendered.

States are (role, begin or inside of a turn). A line emits its speaker marker, whether a blank line
stands before it, whether it ends with a question, and its length class; the state's distributions
of these are independent and are counted, with one added, over all lines of labelled transcripts.

Long transcripts are decoded exactly without being gathered: a transcript is cut into chunks of line
numbers; a chunk's best path scores between all pairs of states form a small matrix; the matrices are
chained per transcript for the states at the cuts, and each chunk is then decoded by Viterbi between
its two known states. Only transcripts of several chunks need the first pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint
from fieldline.operators.segments import running_totals

ROLES = ("system", "user", "assistant", "tool")
N_STATES = 2 * len(ROLES)  # 2 r: a turn of role r begins, 2 r + 1: it goes on
#: Sizes of the emitted features: marker (none or a role), blank before, question, length class.
FEATURES = (1 + len(ROLES), 2, 2, 4)
CHUNK = 1 << 16
#: Turns of one conversation that a task numbers at most, about.
NUMBERED_ROWS = 100_000
_NAMES = {
    "system": "system|instructions?", "user": "user|human|customer|question|prompter|me|q",
    "assistant": "assistant|ai|bot|model|answer|agent|a", "tool": "tool|function|observation",
}
_MARKERS = [
    re.compile(rf"\s*(?:#{{1,6}}\s+(?:{n})\s*:?\s*$|\*\*(?:{n})\s*:?\*\*\s*:?\s*|\[(?:{n})\]\s*:?\s*|<\|?(?:{n})\|?>\s*:?\s*|(?:{n})\s*(?:\(\d+\))?\s*:\s*)", re.I)
    for n in _NAMES.values()
]


def marker(line: str) -> tuple[int, int]:
    """(1 + role, end of the marker) of a line that starts with a speaker marker, else (0, 0)."""
    for r, pattern in enumerate(_MARKERS):
        m = pattern.match(line)
        if m:
            return 1 + r, m.end()
    return 0, 0


def encode(lines: list[str], blank_before: bool = False) -> np.ndarray:
    """(lines, features) of consecutive lines."""
    out = np.zeros((len(lines), len(FEATURES)), np.int64)
    for i, line in enumerate(lines):
        body = line.strip()
        out[i] = marker(line)[0], blank_before, body.endswith("?"), 0 if not body else 1 + (len(body) > 80) + (len(body) > 400)
        blank_before = not body
    return out


@dataclass
class RoleModel:
    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sum(e[:, x[:, k]].T for k, e in enumerate(self.emit))

    def chain(self, x: np.ndarray, first: bool) -> np.ndarray:
        """Best path scores from each state before the lines (row) to each state of the last line."""
        s = self.scores(x)
        m = (np.tile(self.start, (N_STATES, 1)) if first else self.step) + s[0]
        for t in range(1, len(s)):
            m = (m[:, :, None] + self.step[None]).max(axis=1) + s[t]
        return m

    def viterbi(self, x: np.ndarray, enter: int = -1, leave: int = -1) -> np.ndarray:
        """The best states, after state ``enter`` (-1: from the start) and ending in ``leave`` (-1: any)."""
        s = self.scores(x)
        v = (self.start if enter < 0 else self.step[enter]) + s[0]
        back = np.zeros((len(s), N_STATES), np.int64)
        for t in range(1, len(s)):
            ways = v[:, None] + self.step
            back[t] = ways.argmax(axis=0)
            v = ways[back[t], np.arange(N_STATES)] + s[t]
        path = np.empty(len(s), np.int64)
        path[-1] = v.argmax() if leave < 0 else leave
        for t in range(len(s) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


def role_model(counts: dict[tuple[str, int, int], float]) -> RoleModel:
    """From counts ("start", 0, state), ("step", from, to) and (feature number, state, value)."""
    allowed = np.ones((N_STATES, N_STATES), bool)
    for s in range(N_STATES):
        for r in range(len(ROLES)):
            allowed[s, 2 * r + 1] = s // 2 == r  # a turn goes on only in its own role
    start = np.array([counts.get(("start", 0, s), 0) + (s % 2 == 0) for s in range(N_STATES)], float)
    step = np.array([[counts.get(("step", a, b), 0) + 1 for b in range(N_STATES)] for a in range(N_STATES)], float) * allowed
    emit = [np.array([[counts.get((str(k), s, v), 0) + 1 for v in range(n)] for s in range(N_STATES)], float) for k, n in enumerate(FEATURES)]
    with np.errstate(divide="ignore"):
        return RoleModel(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)),
                         [np.log(e / e.sum(axis=1, keepdims=True)) for e in emit])


_STYLES = (("User: ", "Assistant: ", "System: ", "Tool: "), ("Human: ", "AI: ", "System: ", "Function: "),
           ("[USER] ", "[ASSISTANT] ", "[SYSTEM] ", "[TOOL] "), ("### User\n", "### Assistant\n", "### System\n", "### Tool\n"),
           ("**Q:** ", "**A:** ", "**System:** ", "**Tool:** "))


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of a labelled table (conv_id, turn, role, text): conv_id, line_no, line, state.

    A conversation writes its markers in one style (by its id); one turn in eight has no marker, only
    the blank line that ends every turn. ``state`` is the label to learn from. Lines are numbered from 0
    through the conversation in the order of turn (nulls last), role and text; rows that repeat a turn
    follow one another in that order, equal ones too. Unknown roles count as user; null texts are empty;
    rows without conv_id form transcripts of their own content. A conversation with very many rows is
    numbered in segments, by several tasks.
    """
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(1 << 62) + F.xxhash64("role", "text").bitwiseAND(F.lit((1 << 62) - 1)))
    role = F.lower(F.trim(F.coalesce("role", F.lit("user"))))
    number = F.coalesce(*[F.when(role == r, F.lit(i)) for i, r in enumerate(ROLES)], F.lit(1))
    order = (1, 2, 0, 3)  # place of a role in the styles
    style = F.pmod(F.xxhash64(conv, F.lit(1)), F.lit(len(_STYLES)))
    mark = F.coalesce(*[F.when((style == i) & (number == r), s[order.index(r)]) for i, s in enumerate(_STYLES) for r in range(len(ROLES))])
    bare = F.pmod(F.xxhash64(conv, F.col("turn"), F.lit(2)), F.lit(8)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(mark), F.coalesce("text", F.lit("")), F.lit("\n"))
    turns = conversations.select(conv.alias("conv_id"), F.col("turn").isNull().alias("late"), F.col("turn").cast("long").alias("turn"),
                                 number.alias("r"), F.split(text, "\n").alias("own"))
    turns = turns.withColumn("n", F.size("own")).withColumn("h", F.xxhash64("own"))
    keys = ["late", "turn", "r", "h", "own"]
    placed = running_totals(turns, ["n"], "conv_id", keys, NUMBERED_ROWS, F.struct("late", "turn", "r", "h"), "upto")
    lines = placed.select("conv_id", (F.col("upto") - F.col("n")).alias("begin"), "r", F.posexplode("own").alias("i", "line"))
    # Fitting and decoding read the lines several times; the checkpoint keeps their plans short.
    return checkpoint(lines.select("conv_id", (F.col("begin") + F.col("i")).alias("line_no"), "line",
                                   (2 * F.col("r") + (F.col("i") > 0).cast("int")).alias("state")))


def _by_chunk(function, columns: str):
    """Run ``function`` on each (conv_id, chunk) group of a partition that is sorted by it."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        held, at = [], None  # pieces of the group that is still open, and its key
        for pdf in batches:
            if not len(pdf):
                continue
            key = pdf[["conv_id", "chunk"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if held and at != tuple(key[0]):
                yield _each(pd.concat(held, ignore_index=True), [])
                held = []
            if len(cuts):
                whole = pd.concat([*held, pdf.iloc[: cuts[-1]]], ignore_index=True)
                yield _each(whole, cuts[:-1] + sum(map(len, held)))
                held = []
            held.append(pdf.iloc[cuts[-1]:] if len(cuts) else pdf)
            at = tuple(key[-1])
        if held:
            yield _each(pd.concat(held, ignore_index=True), [])

    def _each(pdf, cuts):
        bounds = [0, *cuts, len(pdf)]
        columns_of = {c: pdf[c].to_numpy() for c in pdf.columns}
        rows = []
        for i, j in zip(bounds, bounds[1:]):
            rows.extend(function({c: v[i:j] for c, v in columns_of.items()}))
        return pd.DataFrame(rows, columns=names)

    return run


def _chunked(lines: DataFrame, chunk: int) -> DataFrame:
    return lines.withColumn("chunk", F.floor(F.col("line_no") / F.lit(chunk)).cast("long"))


def _edges(chunked: DataFrame, *carried: str) -> DataFrame:
    """Per (conv_id, chunk): whether it is the first, whether a blank line stands before it, and ``carried`` of the line before."""
    last = F.struct("line_no", "line")
    ends = chunked.groupBy("conv_id", "chunk").agg(
        F.max_by(F.trim("line") == "", last).alias("blank"), *[F.max_by(c, F.struct("line_no", "line", c)).alias(c) for c in carried])
    order = Window.partitionBy("conv_id").orderBy("chunk")
    return ends.select("conv_id", "chunk", F.lag("chunk").over(order).isNull().alias("first"),
                       F.coalesce(F.lag("blank").over(order), F.lit(False)).alias("blank"),
                       *[F.lag(c).over(order).alias(f"before_{c}") for c in carried])


def _sorted(chunked: DataFrame, *last: str) -> DataFrame:
    return chunked.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "line_no", "line", *last)


def _count(g):
    x, s = encode(list(g["line"]), bool(g["blank"][0])), g["state"]
    rows = [("start", 0, s[0]) if g["first"][0] else ("step", int(g["before_state"][0]), s[0])]
    rows += [("step", a, b) for a, b in zip(s, s[1:])]
    rows += [(str(k), a, v) for k in range(len(FEATURES)) for a, v in zip(s, x[:, k])]
    found, n = np.unique(np.array(rows, object).astype(str), axis=0, return_counts=True)
    return [(k, int(a), int(b), int(c)) for (k, a, b), c in zip(found, n)]


def fit_roles(lines: DataFrame, chunk: int = CHUNK) -> RoleModel:
    """Count the model over all ``lines`` (conv_id, line_no, line, state); without lines it is even."""
    chunked = _chunked(lines.withColumn("line", F.coalesce("line", F.lit(""))), chunk)
    columns = "kind string, a int, b int, n long"
    marked = chunked.join(_edges(chunked, "state"), ["conv_id", "chunk"])
    counts = _sorted(marked, "state").mapInPandas(_by_chunk(_count, columns), columns)
    rows = counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()  # at most states x (states + feature values)
    return role_model({(r.kind, r.a, r.b): r.n for r in rows})


def _chain(model: RoleModel):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk", ignore_index=True)
        m = [np.array(x).reshape(N_STATES, N_STATES) for x in pdf["scores"]]
        v = [m[0][0]]
        for x in m[1:]:
            v.append((v[-1][:, None] + x).max(axis=0))
        leave = [int(v[-1].argmax())]
        for c in range(len(m) - 1, 0, -1):
            leave.append(int((v[c - 1] + m[c][:, leave[-1]]).argmax()))
        leave.reverse()
        return pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "enter": [-1, *leave[:-1]], "leave": leave})

    return run


def _decode(model: RoleModel):
    def run(g):
        lines = list(g["line"])
        path = model.viterbi(encode(lines, bool(g["blank"][0])), int(g["enter"][0]), int(g["leave"][0]))
        at, out = None, []
        for no, line, s in zip(g["line_no"], lines, path.tolist()):
            if s % 2 == 0:
                at = no
                line = line[marker(line)[1]:]
            out.append((g["conv_id"][0], g["chunk"][0], no, line, s // 2, at))
        return out

    return run


def decode_lines(lines: DataFrame, model: RoleModel, chunk: int = CHUNK) -> DataFrame:
    """Lines without markers, with role number and the line on which their turn starts (turn_line)."""
    chunked = _chunked(lines.select("conv_id", "line_no", F.coalesce("line", F.lit("")).alias("line")), chunk)
    span = chunked.groupBy("conv_id").agg(F.min("chunk").alias("lowest"), F.max("chunk").alias("highest"))
    several = span.where("lowest < highest").select("conv_id")
    edges = _edges(chunked.join(several, "conv_id", "left_semi"))

    def scores(g):
        m = model.chain(encode(list(g["line"]), bool(g["blank"][0])), bool(g["first"][0]))
        return [(g["conv_id"][0], g["chunk"][0], m.ravel().tolist())]

    columns = "conv_id long, chunk long, scores array<double>"
    matrices = _sorted(chunked.join(edges, ["conv_id", "chunk"])).mapInPandas(_by_chunk(scores, columns), columns)
    cuts = matrices.groupBy("conv_id").applyInPandas(_chain(model), "conv_id long, chunk long, enter int, leave int")
    known = chunked.join(cuts.join(edges.drop("first"), ["conv_id", "chunk"]), ["conv_id", "chunk"], "left")
    known = known.fillna(-1, ["enter", "leave"]).fillna(False, ["blank"])
    columns = "conv_id long, chunk long, line_no long, line string, role int, turn_line long"
    decoded = checkpoint(_sorted(known).mapInPandas(_by_chunk(_decode(model), columns), columns))
    # A chunk may open inside a turn: its start is the last one in an earlier chunk.
    last = decoded.groupBy("conv_id", "chunk").agg(F.max("turn_line").alias("last"), F.min("line_no").alias("first"))
    order = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("open", F.coalesce(F.last("last", ignorenulls=True).over(order), F.col("first"))).select("conv_id", "chunk", "open")
    return decoded.join(last, ["conv_id", "chunk"]).withColumn("turn_line", F.coalesce("turn_line", "open")).drop("open", "chunk")


def format_chat(lines: DataFrame, model: RoleModel, chunk: int = CHUNK) -> DataFrame:
    """One row per recovered turn: conv_id, turn_line, role, text, rendered.

    ``lines``: conv_id, line_no, line (further columns are ignored). Rows of a conversation are ordered
    by turn_line; they are not gathered, so a conversation may have any length. Null lines are empty
    lines; lines that repeat a number are ordered by content; blank ends of a turn are trimmed. An
    empty table gives an empty result.
    """
    turns = decode_lines(lines, model, chunk).groupBy("conv_id", "turn_line").agg(
        F.min("role").alias("r"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("own"))
    text = F.regexp_replace(F.concat_ws("\n", F.transform("own", lambda x: x["line"])), r"^\s+|\s+$", "")
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("r") + 1)
    rendered = F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))
    return turns.select("conv_id", "turn_line", role.alias("role"), text.alias("text"), rendered.alias("rendered"))
