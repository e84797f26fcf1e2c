"""Token counts: a library tokenizer run in Arrow functions that return lengths only.

Each Arrow batch is cut by bytes, not rows, and its texts are cut at white
space.  That cut is safe for a tokenizer whose pre-tokenizer drops white space
(``safe="space"``): no token spans it, its normaliser does not look across it,
and a special string holds none.  The distinct words of a batch are tokenized
once, joined by a special string, and their lengths summed back per text, so
a 20,000-word text costs what its new words cost.  Nothing is truncated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import by_bytes, reduce_sum

#: Words kept per Python worker between batches; beyond it the memo starts anew.
MEMO_WORDS = 400_000
#: Words that one library call takes.
CALL_WORDS = 2_000
LIMIT = 2048


class WordCounter:
    """Tokens per word by a ``tokenizers`` file, memoised within a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.special_id, self.special = special[0]
        self.specials = [s for _, s in special]
        self.memo: dict[str, int] = {}

    def lengths(self, words: list[str]) -> np.ndarray:
        out = np.array([self.memo.get(w, -1) for w in words], dtype=np.int64)
        new = np.flatnonzero(out < 0)
        for at in range(0, len(new), CALL_WORDS):
            part = new[at:at + CALL_WORDS]
            plain = [i for i in part if not any(s in words[i] for s in self.specials)]
            for i in set(part.tolist()) - set(plain):  # a special string in the text: as the library's default
                out[i] = len(self.tokenizer.encode(words[i], add_special_tokens=False))
            if plain:
                joined = "".join(words[i] + self.special for i in plain)
                ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids)
                ends = np.flatnonzero(ids == self.special_id)
                out[plain] = np.diff(np.concatenate([[-1], ends])) - 1
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((words[i], int(out[i])) for i in new[:MEMO_WORDS])
        return out


_counters: dict[str, WordCounter] = {}


def counter(path: str) -> WordCounter:
    if path not in _counters:
        _counters[path] = WordCounter(path)
    return _counters[path]


def count_texts(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text (null: none)."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    coded = pc.dictionary_encode(words.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    if not len(coded):
        return np.zeros(len(texts), dtype=np.int64)
    per_word = counter(path).lengths(coded.dictionary.to_pylist())
    return reduce_sum(per_word[coded.indices.to_numpy()], offsets)


def token_counts(docs: DataFrame, *, file: str = "word_bpe_49k.json", path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    ``file`` names a vocabulary of ``public_tokenizers`` (``path`` overrides it
    by a path).  Its pre-tokenizer must drop white space.  Null and empty texts
    have 0 bytes and 0 tokens; repeated rows and null ids are kept, one row out
    for each row in; other columns are ignored.  No shuffle: one pass over the
    two columns read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or public_tokenizers.path(file)
        for batch in by_bytes(batches, "text"):
            texts = batch.column(1)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n = count_texts(texts, where)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)],
                                             names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
