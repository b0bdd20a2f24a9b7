r"""Chat formatting in budgeted windows.

A conversation's turns, in order, become windows of text. Token counts of turns give prefix sums; a window takes the longest
run of new turns whose tokens fit the budget beside the system turn and a limited history of earlier turns, which
it repeats. A first new turn that needs the room drops history turns, oldest first, and the system turn only if the two alone
exceed the budget; then it is alone in its window. Only assistant texts of new turns are under the loss mask, so each is learned once.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` for a turn. In roles and texts a backslash becomes two and ``<|`` becomes
``<\|``; in roles a line feed becomes ``\n`` spelled with a backslash. `unescape` undoes this exactly.

Rows are dealt by conversation and sorted by turn; tasks stream them, holding one window, so memory doesn't grow with the
length of a conversation. Defined results: null text or role is empty; null conv_id is a conversation of its own; turns of
equal number go by role, then text; repeated rows are repeated turns. A turn beyond the budget gets a window of its own
(over_budget). An empty table gives no windows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUDGET, HISTORY = 512, 2
TURN_OVERHEAD = 4  # tokens of the marks around a turn
FLUSH = 500

WINDOW = "conv_id long, window int, text string, tokens int, over_budget boolean, n_repeated int, n_new int, loss_spans array<struct<start:int,end:int>>"
SIDES = re.compile(r"<\|im_start\|>([^\n]*)\n([\s\S]*?)<\|im_end\|>\n")  # texts hold no "<|"


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(s: str) -> str:
    return escape(s).replace("\n", "\\n")


def unescape(s: str) -> str:
    return re.sub(r"\\([\s\S])", lambda m: "\n" if m[1] == "n" else m[1], s) if "\\" in s else s


@lru_cache(maxsize=2)
def _encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("turns", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


class _Windows:
    """The windows of one conversation at a time, cut out of the prefix sums of its turns' tokens by binary search.

    Turns are held until their sum passes the budget, so the end of a window is known; of the turns before, only the history stays."""

    def __init__(self, count, budget: int, history: int):
        self.count, self.budget, self.history = count, budget, history
        self.begin(object())  # equal to no id

    def begin(self, conv):
        self.conv, self.n, self.system = conv, 0, None
        self.turns, self.sums = [], [0]  # sums[i]: tokens of the turns before i
        self.at = 0  # the first new turn

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        block = f"{START}{escape_role(role)}\n{escape(text)}{END}"
        n = self.count(text) + self.count(role) + TURN_OVERHEAD
        self.turns.append((role, len(START) + len(escape_role(role)) + 1, block, n))
        self.sums.append(self.sums[-1] + n)
        while self.sums[-1] - self.sums[self.at] > self.budget:
            yield self._window()

    def rest(self) -> Iterator[tuple]:
        while self.at < len(self.turns):
            yield self._window()

    def _repeated(self) -> list[tuple]:
        """The system turn, and as many of the last turns before the new ones as the history and half the budget allow; fewer, the
        oldest going first, where the first new turn needs the room. The system turn goes only if it doesn't fit beside that turn."""
        head = [self.system] if self.system else []
        taken = sum(t[3] for t in head)
        left = self.budget - taken - self.turns[self.at][3]
        if left < 0:
            return []
        room = min(self.budget // 2 - taken, left)
        first = bisect_left(self.sums, self.sums[self.at] - room, max(0, self.at - self.history), self.at)
        return head + self.turns[first : self.at]

    def _window(self) -> tuple:
        rep = self._repeated()
        taken, end = sum(t[3] for t in rep), self.at + 1
        if rep or not self.system:
            end = max(end, bisect_right(self.sums, self.sums[self.at] + self.budget - taken) - 1)
        new, tokens = self.turns[self.at : end], taken + self.sums[end] - self.sums[self.at]
        parts, spans, at = [], [], 0
        for k, (role, head, block, _) in enumerate([*rep, *new]):
            if k >= len(rep) and role == "assistant":
                spans.append({"start": at + head, "end": at + len(block) - len(END)})
            parts.append(block)
            at += len(block)
        out = (self.conv, self.n, "".join(parts), tokens, tokens > self.budget, len(rep), len(new), spans)
        past = max(0, end - self.history)
        if self.n == 0 and new[0][0] == "system":
            self.system, past = new[0], max(1, past)
        self.turns, self.sums = self.turns[past:], self.sums[past:]
        self.at, self.n = end - past, self.n + 1
        return out


def _ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(F.col(keys[0])).sortWithinPartitions(*keys)


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str | None = VOCABULARY) -> DataFrame:
    """One row for each window. vocabulary: a file of BPE ranks, or None to count words and marks instead."""
    ranks = open(vocabulary, "rb").read() if vocabulary else b""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(WINDOW))

    def run(batches):
        if ranks:
            enc = _encoder(ranks)
            count = lambda s: len(enc.encode_ordinary(s))
        else:
            count = lambda s: len(re.findall(r"\w+|[^\w\s]", s))

        def rows():
            w = _Windows(count, budget, history)
            for conv, _, role, text in _flat(batches):
                if conv != w.conv:
                    yield from w.rest()
                    w.begin(conv)
                yield from w.turn(role, text)
            yield from w.rest()

        return _batches(rows(), schema)

    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return _ordered(turns, "conv_id", "turn", "role", "text").mapInArrow(run, WINDOW)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows' texts and masks alone: turns and loss texts with their digests."""
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(out))

    def run(batches):
        def rows():
            cur, state = None, None
            for conv, _, text, repeated, spans in _flat(batches):
                if state is None or conv != cur:
                    if state:
                        yield close(cur, state)
                    cur, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for k, m in enumerate(SIDES.finditer(text)):
                    if k >= repeated:
                        state[0] += 1
                        state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                for s in spans:
                    said = unescape(text[s["start"] : s["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += 1
            if state:
                yield close(cur, state)

        close = lambda c, s: (c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5])
        return _batches(rows(), schema)

    w = windows.select("conv_id", "window", "text", "n_repeated", "loss_spans")
    return _ordered(w, "conv_id", "window").mapInArrow(run, out)
