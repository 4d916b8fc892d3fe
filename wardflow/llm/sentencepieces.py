"""SentencePiece encoding and decoding by a table of distinct marked words.

In a vocabulary none of whose pieces has a white-space mark after another character,
no merge crosses the start of a marked word. So a text can be cut before each run of
marks, each distinct piece of text is segmented once by the library, and the ids of a
text are joined by the places of its words. A character that occurs in no piece (such
as a line end) can not be merged either and parts the text as well.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from wardflow.llm.batches import add_columns, lists, strings

MARK = "▁"
#: The table of a task starts anew when it holds so many distinct words or characters.
TABLE_WORDS = 100_000
TABLE_CHARS = 3_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class WordTable:
    """Ids and decoded text of distinct marked words, segmented by the library."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        normal = [p for i, p in enumerate(pieces) if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))]
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece of this model crosses white space; words can not be segmented apart")
        if self.sp.encode("x  y") == self.sp.encode("x y") or "\n" in set("".join(normal)):
            raise ValueError("this model joins white space; words can not be segmented apart")
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.mark = [self.sp.piece_to_id(MARK)]
        # What the library puts before a line end: taken off where a part has no mark.
        self.lead = len(self.sp.encode("\n"))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.begins, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.decoded = np.empty(0, np.int32), []

    def add(self, parts: list[str]) -> None:
        """Segment new parts, all in one call of the library."""
        marked = [p.startswith(MARK) for p in parts]
        asked = [p[1:] if m else "\n" + p for p, m in zip(parts, marked)]
        found = []
        for part, m, ids in zip(parts, marked, self.sp.encode(asked, num_threads=1)):
            found.append((ids or self.mark) if m else ids[self.lead :])
        texts = self.sp.decode(found) if found else []
        # The library takes one leading space off what it decodes.
        self.decoded += [" " + t if m else t for t, m in zip(texts, marked)]
        self.chars += sum(map(len, parts))
        self.place.update(zip(parts, range(len(self.place), len(self.place) + len(parts))))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        begins = len(self.ids) + np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        self.begins, self.lengths = np.concatenate((self.begins, begins)), np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids without an end id, where each text's ids begin, and the decoded texts."""
        cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.place) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self.clear()
        new = {p for parts in cut for p in parts}.difference(self.place)
        self.add(sorted(new))
        count = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter((self.place[p] for parts in cut for p in parts), np.int64, int(count.sum()))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.begins[at] - (ends - lengths), lengths)]
        offsets = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(count)))]
        decoded = ["".join([self.decoded[self.place[p]] for p in parts])[1:] for parts in cut]
        return ids, offsets, decoded


def encode_decode(df: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``df`` with ``ids`` (end id included) and ``decoded``, the text of these ids.

    A NULL text is an empty one: its only id is the end id. Rows are neither joined
    nor moved, so repeated rows, NULL ids and other columns stay as they are; columns
    of ``df`` named ``ids`` or ``decoded`` are replaced.
    """
    path = model or default_model()
    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("decoded", StringType())]

    def start():
        table = WordTable(path)
        end = table.sp.eos_id()

        def work(texts: pa.Array) -> list:
            ids, offsets, decoded = table.encode(strings(texts))
            ids = np.insert(ids, offsets[1:], end)
            return [lists(ids, offsets + np.arange(len(offsets)), pa.int32()), pa.array(decoded, pa.string())]

        return work

    return add_columns(df, fields, text, start)
