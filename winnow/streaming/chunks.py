"""Messages that arrive in chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PIECE_SCHEMA = "conv_id bigint, at bigint, text string"


def _unbroken(chunk: Column) -> Column:
    """The parts between newlines, empty ones dropped, put together."""
    return F.replace(chunk, F.lit("\n"), F.lit(""))


def chunk_reassembly(chunks: DataFrame) -> DataFrame:
    """(conv_id, completion): the text of all chunks of a conversation, in order."""
    pieces = F.array_sort(
        F.collect_list(F.struct("seq", _unbroken(F.col("chunk")).alias("text")))
    )
    whole = F.array_join(F.transform(pieces, lambda p: p.getField("text")), "")
    return chunks.groupBy("conv_id").agg(whole.alias("completion"))


class ChunkProcessor(StatefulProcessor):
    """Per conversation: the next chunk number, the characters so far, chunks ahead of turn."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "seq bigint, chars bigint")
        self.early = handle.getMapState("early", "seq bigint", "chunk string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seq, chars = self.place.get() if self.place.exists() else (0, 0)
        fresh = {}
        for frame in rows:
            for number, chunk in zip(frame["seq"].tolist(), frame["chunk"].tolist(), strict=True):
                if number >= seq:
                    fresh[number] = chunk or ""
        # Only chunks that stay ahead of their turn go through the state.
        waiting = self.early.exists()
        ready = []
        while True:
            held = waiting and self.early.containsKey((seq,))
            if seq not in fresh and not held:
                break
            chunk = fresh.pop(seq) if seq in fresh else self.early.getValue((seq,))[0]
            if held:
                self.early.removeKey((seq,))
            ready.append(chunk.replace("\n", ""))
            seq += 1
        for number, chunk in fresh.items():
            self.early.updateValue((number,), (chunk,))
        text = "".join(ready)
        self.place.update((seq, chars + len(text)))
        if text:
            yield pd.DataFrame({"conv_id": [key[0]], "at": [chars], "text": [text]})

    def close(self) -> None:
        pass


def chunk_stream(chunks: DataFrame) -> DataFrame:
    """(conv_id, at, text): what each batch adds to a conversation, with its character offset."""
    return (
        chunks.select("conv_id", "seq", "chunk")
        .groupBy("conv_id")
        .transformWithStateInPandas(
            ChunkProcessor(), PIECE_SCHEMA, outputMode="append", timeMode="none"
        )
    )
