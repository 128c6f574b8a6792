"""Byte-level BPE with the tiktoken library and a local rank file: encoding and raw-byte decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters given to the library at a time.
SPAN = 1 << 15
_SAFE = re.compile(r"(?<=\S)(?=\s)|(?<=[^\W\d_])(?=[0-9])")
_known: dict[tuple[str, str], tuple] = {}


def encoding(ranks: bytes, pattern: str):
    """This worker's (Encoding, decimal string of each id) of a rank file's content."""
    key = (hashlib.md5(ranks).hexdigest(), pattern)
    if key not in _known:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        own = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _known[key] = own, [str(i) for i in range(own.n_vocab)]
    return _known[key]


def spans(text: str, size: int = SPAN) -> Iterator[str]:
    """``text`` in spans of about ``size`` characters that can be encoded one by one.

    A span ends where white space follows a character that is none, or a digit follows a letter: there
    every match of the pattern ends and no match looks back. A text without such a place stays whole.
    """
    at = 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size)
        if not found or found.start() >= len(text):
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def encode(own, text: str) -> list[int]:
    if len(text) <= SPAN:
        return own.encode_ordinary(text)
    ids: list[int] = []
    for part in spans(text):
        ids += own.encode_ordinary(part)
    return ids


def byte_bpe(
    docs: DataFrame, ranks: bytes, pattern: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text and decode its ids again, where the rows lie (no exchange).

    Returns ``keep`` and n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256
    (of the decoded bytes) and, on demand, ids and decoded. NULL texts are encoded as empty ones;
    repeated rows give repeated results.
    """
    spark = docs.sparkSession
    source = spark.sparkContext.broadcast(ranks)
    kept = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    fields += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>", "decoded binary"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, decimal = encoding(source.value, pattern)
        for batch in batches:
            counts, sums, back, all_ids, raws = [], [], [], [], []
            for value in batch.column(batch.num_columns - 1):
                ids = encode(own, value.as_py() or "")
                raw = own.decode_bytes(ids)
                counts.append(len(ids))
                sums.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(raw).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    raws.append(raw)
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())]
            names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(raws, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, ", ".join(fields))
