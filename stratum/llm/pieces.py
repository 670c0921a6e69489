"""SentencePiece encoding and decoding by a table of distinct chunks.

In a BPE piece model whose pieces have the space marker at their front only,
no merge crosses from a character to a marker behind it: a text falls into
chunks (markers and what follows up to the next marker) that merge on their
own. Each task segments every distinct chunk once, all unseen ones together
(`merging.PairTable`), and joins their ids back by position. Rows are
independent, so nothing is shuffled and a lost task is simply run again; the
table of a worker holds a bounded number of chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.bpe import shared_vocabulary
from stratum.llm.common import slices
from stratum.llm.merging import PieceVocabulary

_VOCABULARIES: dict[int, PieceVocabulary] = {}


def vocabulary_of(data: bytes) -> PieceVocabulary:
    """The model, made once in a worker."""
    return _VOCABULARIES.get(hash(data)) or _VOCABULARIES.setdefault(hash(data), PieceVocabulary(data))


def encode_pieces(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", out: str = "ids") -> DataFrame:
    """Encode every text with an end id, then decode the ids.

    Returns per row: the id column, `ids` (array<long>) if out="ids", else
    digests: `n_tokens`, `ids_sha256` (decimal ids joined by spaces) and
    `decoded_sha256` (the decoded text in UTF-8). Null and empty texts have
    the end id only and decode to an empty text. Rows are independent:
    repeated ids and texts give repeated rows, an empty table gives none;
    other columns are not carried.
    """
    shared, digests = shared_vocabulary(docs.sparkSession, model), out != "ids"
    key = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {key}, " + ("n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value)
        decimal = [str(i) for i in range(vocabulary.n_pieces)]
        for whole in batches:
            for batch in slices(whole, "__text"):
                flat, counts = vocabulary.encode([t or "" for t in batch.column("__text").to_pylist()])
                ends, made = np.cumsum(counts), [[], [], []]
                for a, b in zip((ends - counts).tolist(), ends.tolist()):
                    ids = flat[a:b].tolist()
                    ids.append(vocabulary.end)
                    if digests:
                        made[0].append(len(ids))
                        made[1].append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                        made[2].append(hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest())
                    else:
                        made[0].append(ids)
                kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int64()),)
                names = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("ids",)
                yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(x, y) for x, y in zip(made, kinds))], [id_col, *names])

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def decode_pieces(rows: DataFrame, model: str, *, id_col: str = "doc_id") -> DataFrame:
    """Rows of (id, `ids`) to (id, `text`), as the library decodes; null ids give an empty text."""
    shared = shared_vocabulary(rows.sparkSession, model)
    key = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value)
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(texts, pa.string())], [id_col, "text"])

    return rows.select(F.col(id_col).alias("__id"), "ids").mapInArrow(run, f"`{id_col}` {key}, text string")
