"""Chat formatting: typed content parts, a reversible template and the loss mask.

A message is a role and content parts of type text, image, audio or document. A visitor walks the parts in order:
text goes in escaped, each attachment becomes a placeholder numbered within its conversation, its reference is
recorded, and the expanded token count is what the placeholder stands for (per image, per second of audio, per page).

Template: `<s>[role] text [/role]</s>` a turn. Inside texts `\\`, `<`, `>`, `[` and `]` get a backslash before them, so no
text can hold a control string, and one that holds it comes back unchanged. The loss mask covers assistant texts.

One row a turn goes out (segment, loss span), and a conversation is its segments in order: rows are dealt by conv_id,
sorted by turn and streamed, so memory holds one turn at a time however long a conversation is. A hash of a whole
conversation needs its turns in order, so one conversation's turns pass through one task (as a stream).

Defined cases: null text is empty; a null role is the empty role; null conv_ids are one conversation; equal turns are
ordered by role, then text (content: its JSON); columns other than these are ignored, whatever their names; an empty table gives no rows; parts of unknown type are kept as documents of one page.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Expanded tokens of one unit: an image, a second of audio, a page of a document.
TOKENS = {"image": 256, "audio": 25, "document": 512}
_SPECIAL = re.compile(r"[\\<>\[\]]")
_ESCAPED = re.compile(r"\\(.)", re.S)
PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"
_SEGMENT = "conv_id long, turn long, seq long, role string, segment string, loss_start long, loss_end long, attachments array<struct<slot:int,type:string,ref:string>>, expanded_tokens long"


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Visitor:
    """Flattens the parts of one message; slots go on through the conversation."""

    def __init__(self, slot: int = 0):
        self.slot, self.out, self.attachments, self.tokens = slot, [], [], 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def _attach(self, kind: str, part: dict) -> None:
        self.out.append(f"<{kind}_{self.slot}>")
        self.attachments.append({"slot": self.slot, "type": kind, "ref": part.get("ref")})
        self.tokens += TOKENS[kind] * max(1, part.get("units") or 1)
        self.slot += 1

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)


def segment_of(role: str, body: str) -> tuple[str, int]:
    """A turn's segment, and where its body begins."""
    tag = escape(role)
    head = f"<s>[{tag}] "
    return f"{head}{body} [/{tag}]</s>", len(head)


_TURN = re.compile(r"<s>\[((?:[^\\\]]|\\.)*)\] (.*) \[/\1\]</s>", re.S)


def parse_segment(segment: str) -> tuple[str, str]:
    """(role, body still escaped) of a segment."""
    tag, body = _TURN.fullmatch(segment).groups()
    return unescape(tag), body


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within partitions: conv_id, turn, seq, role, segment, loss_start and loss_end (code
    points within the segment, null if not an assistant's), attachments, expanded_tokens.

    turns has conv_id, turn, role and text, or content (PARTS) instead of text.
    """
    parts = "content" in turns.columns
    body = F.col("content").cast(PARTS).alias("content") if parts else F.coalesce("text", F.lit("")).alias("content")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), body)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.to_json("content") if parts else F.col("content"))

    def run(batches):
        last, seq, slot = object(), 0, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv_id"] != last:
                    last, seq, slot = r["conv_id"], 0, 0
                v = Visitor(slot)
                for part in (r["content"] or ()) if parts else ({"type": "text", "text": r["content"]},):
                    v.visit(part or {"type": "text"})
                body = "".join(v.out)
                segment, at = segment_of(r["role"], body)
                loss = (at, at + len(body)) if r["role"] == "assistant" else (None, None)
                out.append({"conv_id": last, "turn": r["turn"], "seq": seq, "role": r["role"], "segment": segment, "loss_start": loss[0], "loss_end": loss[1], "attachments": v.attachments, "expanded_tokens": v.tokens})
                seq, slot = seq + 1, v.slot
            yield pa.RecordBatch.from_pylist(out, _schema())

    return rows.mapInArrow(run, _SEGMENT)


def _schema() -> pa.Schema:
    return pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", pa.list_(pa.struct([("slot", pa.int32()), ("type", pa.string()), ("ref", pa.string())]))), ("expanded_tokens", pa.int64())])


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the segments alone.

    segments come straight from format_turns: each conversation's rows together and in order.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        now, state = None, None

        def row():
            n, turns, chars, loss, length = state
            return dict(zip(names, (now, n, turns.hexdigest(), chars, loss.hexdigest(), length)))

        for batch in batches:
            out = []
            for conv_id, segment, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))):
                if state is None or conv_id != now:
                    if state is not None:
                        out.append(row())
                    now, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = parse_segment(segment)
                state[0] += 1
                state[1].update(f"{role}\n{unescape(body)}\n".encode())
                if a is not None:
                    text = unescape(segment[a:b])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(segment)
            if out:
                yield pa.RecordBatch.from_pylist(out, _digest())
        if state is not None:
            yield pa.RecordBatch.from_pylist([row()], _digest())

    def _digest():
        return pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    return segments.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
