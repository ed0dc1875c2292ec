"""Token counts by a whole-token shortcut.

For a vocabulary without a piece that holds a space mark behind another character, no merge
crosses from a word into the space before the next word. Counting is then a sum over
pre-tokens (a run of space marks with the word behind it). Offline, once per model and Python worker
(workers are reused by later tasks), every vocabulary string of that form is encoded alone; those that give exactly one token
are proved whole, and a pre-token among them counts 1 without merging. Only the rest is
merged by the library, each distinct pre-token once per batch of texts (a bounded memo).

Scale: a map over Arrow batches without a shuffle; memory is the vocabulary, the memo
(``MEMO`` entries at most, then emptied) and one slice of texts.

Defined cases: null and empty texts have 0 tokens; texts of any length are counted whole; null ids and
repeated rows give results of their own, row by row; other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO = 400_000
LONG = 64
SLICE = 256
MARK = "▁"


class PieceCounter:
    """Counts tokens as the sentencepiece library does for a BPE model with an identity normaliser."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = pb.ModelProto()
        model.ParseFromString(self.sp.serialized_model_proto())
        norm = model.normalizer_spec
        plain = norm.name == "identity" and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
        pieces = [p.piece for p in model.pieces if p.type in (1, 4, 5)]
        self.splits = plain and not any(MARK in p.lstrip(MARK) for p in pieces)
        whole = [p for p in pieces if p.startswith(MARK) and len(p) > 1]
        ids = self.sp.encode([p[1:].replace(MARK, " ") for p in whole], num_threads=1) if self.splits else []
        #: pre-token without its first space mark -> 1, proved by encoding it alone
        self.whole = {p[1:].replace(MARK, " "): 1 for p, x in zip(whole, ids) if len(x) == 1}
        if self.splits and self.sp.piece_to_id(MARK) != self.sp.unk_id():
            self.whole[""] = 1
        self.memo = dict(self.whole)

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens without their first space mark; the text itself begins with one."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text.startswith(" "):
            return [x[1:] for x in re.findall(r" +[^ ]*", " " + text)]
        return text.split(" ")

    def counts(self, texts: list[str | None]) -> list[int]:
        if not self.splits:
            return [len(x) for x in self.sp.encode([t or "" for t in texts], num_threads=1)]
        if len(self.memo) > MEMO:
            self.memo = dict(self.whole)
        memo, out = self.memo, []
        split = [self.pretokens(t) if t else [] for t in texts]
        missing = list({w for words in split for w in words}.difference(memo))
        fresh = dict(zip(missing, map(len, self.sp.encode(missing, num_threads=1)))) if missing else {}
        memo.update(fresh)
        for words in split:
            out.append(sum(map(memo.__getitem__, words)))
        for w in missing:
            if len(w) > LONG:
                del memo[w]
        return out


_counters: dict[str, PieceCounter] = {}


def counter_of(model_file: str) -> PieceCounter:
    """The counter of a model, made once in each process."""
    if model_file not in _counters:
        _counters[model_file] = PieceCounter(model_file)
    return _counters[model_file]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row; ``model_file`` is readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_file)
        for batch in batches:
            texts, n = batch.column(1), []
            for at in range(0, batch.num_rows, SLICE):
                n += counter.counts(texts.slice(at, SLICE).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), size.alias("n_bytes"))
        .mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
