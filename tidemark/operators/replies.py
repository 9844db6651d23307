"""Windows proposed in model replies: the best JSON value in free text, repaired where it can be.

Finding candidates needs a scan of characters, which runs in Python over Arrow batches; which candidate wins is decided by
Spark over all candidates of a reply."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dataset import newest_per

_FENCE = re.compile(r"```[A-Za-z]*\s*\n?(.*?)(?:```|\Z)", re.S)
# Quotes and spaces of other scripts, and characters without width, as models write them.
_QUOTES = str.maketrans({
    "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"',
    "\u00a0": " ", "\u2028": "\n", "\u2029": "\n", "\u200b": None, "\u200c": None, "\u200d": None, "\u2060": None, "\ufeff": None,
})
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|"(?:[^"\\]|\\.)*\Z|//[^\n]*|/\*.*?(?:\*/|\Z)|[{}\[\],]|[^"/{}\[\],]+|/', re.S)
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_PAIRS = {"{": "}", "[": "]"}


def balanced_values(text: str) -> Iterator[tuple[int, str]]:
    """(position, text) of every outermost object or array; the last may be cut off."""
    depth, start = [], 0
    for m in _TOKEN.finditer(text):
        t = m[0]
        if t in _PAIRS:
            start = start if depth else m.start()
            depth.append(_PAIRS[t])
        elif depth and t in "}]" and t == depth[-1]:
            depth.pop()
            if not depth:
                yield start, text[start : m.end()]
    if depth:
        yield start, text[start:]


class _Repairs:
    """One pass over a text: without comments and trailing commas, what is open at its end, and every place where it could
    be cut off and closed, with what is open there (a stack whose rest is shared)."""

    def __init__(self, text: str):
        parts, size, open_ = [], 0, None
        self.marks: list[tuple[int, tuple | None]] = []
        for m in _TOKEN.finditer(text):
            t = m[0]
            if t.startswith(("//", "/*")):
                continue
            if t in ("}", "]"):
                while parts and (not parts[-1].strip() or parts[-1] == ","):
                    size -= len(parts.pop())
                if open_ and open_[0] == t:
                    open_ = open_[1]
            if t == "," and open_:
                self.marks.append((size, open_))
            parts.append(t)
            size += len(t)
            if t in _PAIRS:
                open_ = (_PAIRS[t], open_)
            elif t in ("}", "]"):
                self.marks.append((size, open_))
        self.plain, self.open = "".join(parts), open_
        tail = parts[-1] if parts else ""
        self.in_string = tail.startswith('"') and (len(tail) == 1 or not _STRING.fullmatch(tail))

    @staticmethod
    def _closers(open_: tuple | None) -> str:
        out = []
        while open_:
            out.append(open_[0])
            open_ = open_[1]
        return "".join(out)

    def closed(self) -> str:
        return (self.plain + '"' * self.in_string).rstrip().rstrip(",") + self._closers(self.open)

    def cut(self, size: int, open_: tuple | None) -> str:
        return self.plain[:size] + self._closers(open_)


def _loaded(text: str):
    """(value, None), or (None, the place of the first thing that is wrong)."""
    try:
        return json.loads(text), None
    except ValueError as e:
        return None, e.pos
    except RecursionError:
        return None, 0


def parsed(text: str):
    """The value of a text that is JSON, or can be made so, or None: as it is, then without comments and trailing commas, then
    with what is open closed, then cut off at the last place where it can be closed.

    What is wrong at some place stays wrong whatever is cut off behind it, so the first wrong place of the closed text
    tells which cuts are worth a try: the last one before it, or the next if that one was in the middle of a pair. The time
    is in proportion to the text."""
    value, wrong = _loaded(text)
    if wrong is None:
        return value
    repair = _Repairs(text)
    value, wrong = _loaded(repair.plain)
    if wrong is None:
        return value
    value, wrong = _loaded(repair.closed())
    if wrong is None:
        return value
    for size, open_ in reversed(repair.marks):
        if size <= wrong:
            value, at = _loaded(repair.cut(size, open_))
            if at is None:
                return value
            wrong = min(wrong, at)
    return None


def shape_score(value, required: list[str]) -> int:
    """How much a value looks like the wanted object: wanted keys count, earlier ones more, other cases of them less. A bare
    list may be the list that was meant."""
    if isinstance(value, list):
        return 5 if value and isinstance(value[0], dict) else 3
    if not isinstance(value, dict):
        return 0
    lower = {k.lower() for k in value}
    score = sum((10 if k in value else 6) - i for i, k in enumerate(required) if k in value or k in lower)
    return score or int(bool(value))


def parse_model_replies(df: DataFrame, required: list[str], id: str = "reply_id", text: str = "text") -> DataFrame:
    """(id, value, score): the best JSON value of each reply as text; replies without any are left out.

    Fenced blocks and the whole text are searched for objects and arrays; each is parsed, repaired if need be, and scored
    by shape. The best score wins, fenced before loose, the last of equals. A bare list becomes the first wanted key."""

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, reply in zip(batch["id"], batch["text"], strict=True):
                clean = (reply or "").replace("\r\n", "\n").replace("\r", "\n").translate(_QUOTES)
                for rank, blobs in enumerate(([m[1] for m in _FENCE.finditer(clean)], [clean])):
                    for n, blob in enumerate(blobs):
                        for at, raw in balanced_values(blob):
                            value = parsed(raw)
                            if value is None:
                                continue
                            score = shape_score(value, required)
                            if isinstance(value, list) and required:
                                value = {required[0]: value}
                            rows.append((key, json.dumps(value, ensure_ascii=False), score, rank, n, at))
            yield pd.DataFrame(rows, columns=["id", "value", "score", "rank", "block", "pos"])

    kind = df.schema[id].dataType.simpleString()
    found = df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInPandas(candidates, f"id {kind}, value string, score int, rank int, block bigint, pos bigint")
    best = newest_per(found.where("score > 0"), ["id"], [F.desc("score"), F.asc("rank"), F.desc("block"), F.desc("pos")])
    return best.select(F.col("id").alias(id), "value", "score")


PROPOSAL = (
    "task_id string, title string, summary string, start_ts string, end_ts string, confidence double, participants array<string>,"
    " evidence struct<message_ids: array<string>, ticket: string, pr_numbers: array<int>, merge_shas: array<string>>, reasoning string"
)


def load_proposals(df: DataFrame, id: str = "reply_id", text: str = "text") -> DataFrame:
    """The windows proposed in model replies, one row each: what validate_windows takes."""
    best = parse_model_replies(df, ["windows"], id, text)
    windows = F.from_json(F.get_json_object("value", "$.windows"), f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in _fields(PROPOSAL))}>>")
    return best.select(id, F.explode(windows).alias("w")).select(id, "w.*")


def _fields(schema: str) -> list[str]:
    """The top-level fields of a schema text."""
    parts, depth, held = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            parts.append(held.strip())
            held = ""
        else:
            held += ch
    return [*parts, held.strip()]
