"""Chat formatting: whole conversations rendered and encoded once, loss masks aligned by offsets."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a turn: turn, role, body, text, end. They become single ids of the tokenizer.

    A control string inside a role or text gets a backslash after its first sign, and one that already
    has backslashes there gets one more; taking one away is the exact reverse. reserved: strings that other
    templates and tokenizers give a meaning, escaped as well.
    """

    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "<|startoftext|>")

    @property
    def marks(self) -> tuple[str, ...]:
        return (self.turn, self.body, self.end)

    def escape(self, text: str) -> str:
        pattern = _pattern(self, r"\\*")
        return pattern.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text) if self._may_hold(text) else text

    def unescape(self, text: str) -> str:
        pattern = _pattern(self, r"\\+")
        return pattern.sub(lambda m: f"{m[0][0]}{m[0][2:]}", text) if self._may_hold(text) else text

    def _may_hold(self, text: str) -> bool:
        return any(sign in text for sign in {c[0] for c in (*self.marks, *self.reserved)})

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The formatted conversation, and where each turn's text stands in it."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head = f"{self.turn}{self.escape(role)}{self.body}"
            own = self.escape(text)
            spans.append((at + len(head), at + len(head) + len(own)))
            parts += [head, own, self.end]
            at += len(head) + len(own) + len(self.end)
        return "".join(parts), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted conversation."""
        out = []
        for part in formatted.split(self.end)[:-1]:
            role, text = part.removeprefix(self.turn).split(self.body, 1)
            out.append((self.unescape(role), self.unescape(text)))
        return out


@functools.cache
def _pattern(template: Template, slashes: str) -> re.Pattern:
    """The control strings of a template, with backslashes after the first sign."""
    each = (f"{re.escape(c[0])}{slashes}{re.escape(c[1:])}" for c in (*template.marks, *template.reserved))
    return re.compile("|".join(each))


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (from starts to ends, in order) lie in one of the sorted spans, by binary search."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans).T
    k = np.searchsorted(first, starts, "right") - 1
    return (k >= 0) & (ends <= last[np.maximum(k, 0)]) & (ends > starts)


def masked_text(formatted: str, starts, ends, mask) -> str:
    """The text under a mask. Tokens that share a sign, as parts of its bytes, give it once."""
    mask = np.asarray(mask, bool)
    a, b = np.asarray(starts)[mask], np.asarray(ends)[mask]
    if not len(a):
        return ""
    reached = np.maximum.accumulate(b)
    cuts = np.flatnonzero(a[1:] > reached[:-1]) + 1  # where tokens do not touch those before
    runs = zip(a[np.append(0, cuts)].tolist(), reached[np.append(cuts, len(a)) - 1].tolist(), strict=True)
    return "".join(formatted[x:y] for x, y in runs)


_tokenizers: dict = {}


def _tokenizer(path: str, template: Template):
    """The tokenizer with the template's marks added as ids of their own, so none of them joins what is beside."""
    key = (path, template)
    if key not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in template.marks])
        t.post_processor = processors.ByteLevel(trim_offsets=False)  # spaces belong to the token they start
        _tokenizers[key] = t
    return _tokenizers[key]


def _conversations(batches, columns: list[str]) -> Iterator[tuple]:
    """(key, [(role, text)]) of each run of rows of one conversation in sorted batches."""
    key, turns = None, []
    for batch in batches:
        for own, conv_id, role, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True):
            if key is not None and own != key[0]:
                yield key[1], turns
                turns = []
            key = (own, conv_id)
            turns.append((role or "", text or ""))
    if key is not None:
        yield key[1], turns


_FORMATTED = {
    "conv_id": pa.int64(), "n_turns": pa.int64(), "formatted": pa.string(), "ids": pa.list_(pa.int32()), "starts": pa.list_(pa.int32()),
    "ends": pa.list_(pa.int32()), "loss": pa.list_(pa.bool_()),
}


def format_chats(
    turns: DataFrame, tokenizer: str, *, template: Template | None = None, loss_roles: tuple[str, ...] = ("assistant",),
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """A row for each conversation: conv_id, n_turns, formatted (text), ids, starts and ends (offsets of each id in
    formatted), loss (true for ids of texts of loss_roles).

    The whole conversation is rendered in the order of turns and encoded once, by a byte-level tokenizer with
    offsets; the mask comes from meeting the sorted spans of the turns with the spans of the tokens. Rows are
    sorted by conversation and streamed, so a task holds one conversation at a time.

    Null texts and roles are empty. A null turn comes first; rows of one turn are ordered by role and
    text. Rows that are alike are turns each. A row without conv_id is a conversation by itself, so such rows do
    not gather in one task. An empty table gives no rows. Other columns are not read.

    A very long text is rendered and encoded whole, like any other: a conversation, its ids and its offsets have to fit into a
    worker. Offsets are of 32 bits, so a conversation of 2**31 code points and more raises an error instead of wrapping.
    """
    template = template or Template()

    def made(group: list[tuple]) -> pa.RecordBatch:
        rendered = [template.render(own) for _, own in group]
        found = _tokenizer(tokenizer, template).encode_batch([text for text, _ in rendered], add_special_tokens=False)
        offsets, masks = [], []
        for x, (text, spans), (_, own) in zip(found, rendered, group, strict=True):
            if len(text) >= 1 << 31:
                raise ValueError("a conversation of 2**31 code points or more")
            offsets.append(np.fromiter(chain.from_iterable(x.offsets), np.int32, 2 * len(x)).reshape(-1, 2))
            wanted = [span for span, (role, _) in zip(spans, own, strict=True) if role in loss_roles and span[0] < span[1]]
            masks.append(loss_mask(offsets[-1][:, 0], offsets[-1][:, 1], wanted))
        both, ends = np.concatenate(offsets), np.cumsum([0, *map(len, masks)]).astype(np.int32)
        each = lambda values: pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
        ids = np.concatenate([np.array(x.ids, np.int32) for x in found])
        columns = [pa.array([i for i, _ in group], pa.int64()), pa.array([len(own) for _, own in group], pa.int64()), pa.array([text for text, _ in rendered])]
        columns += [each(ids), each(np.ascontiguousarray(both[:, 0])), each(np.ascontiguousarray(both[:, 1])), each(np.concatenate(masks))]
        return pa.RecordBatch.from_arrays(columns, list(_FORMATTED))

    def run(batches):
        group, size = [], 0
        for conv_id, own in _conversations(batches, ["key", "conv_id", "role", "text"]):
            group.append((conv_id, own))
            size += sum(len(text) for _, text in own)
            if size > 1 << 19:
                yield made(group)
                group, size = [], 0
        if group:
            yield made(group)

    rows = turns.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    alone = F.concat(F.lit("n"), F.monotonically_increasing_id())
    rows = rows.withColumn("key", F.when(F.col("conv_id").isNull(), alone).otherwise(F.concat(F.lit("c"), "conv_id")))
    rows = rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    kinds = "conv_id long, n_turns long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
    return rows.mapInArrow(run, kinds)


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """What format_chats() made, read back: turns from the formatted text, the loss text from mask and offsets."""
    template = template or Template()

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def run(batches):
        for batch in batches:
            out, column = [], {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            cuts = column["ids"].offsets.to_numpy()
            starts, ends, loss = (column[c].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss"))
            for i, (conv_id, formatted) in enumerate(zip(column["conv_id"].to_pylist(), column["formatted"].to_pylist(), strict=True)):
                a, b = cuts[i], cuts[i + 1]
                turns = template.parse(formatted)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                text = template.unescape(masked_text(formatted, starts[a:b], ends[a:b], loss[a:b]))
                out.append((conv_id, len(turns), sha(whole), len(text), sha(text), len(formatted), int(b - a)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    return chats.mapInArrow(run, kinds)
