"""Length-delimited binary token records with masked checksums and an offset index.

A shard holds the records of one range of ids. Record: payload length (uint64),
masked CRC-32 of those 8 bytes (uint32), payload, masked CRC-32 of the payload
(uint32), all little-endian. The payload is the sequence's ids as uint16 or
uint32. A CRC is masked by a right rotation of 15 bits plus a constant, so that
checksums of data holding checksums stay useful. Beside each shard an index file
holds one fixed-width entry per record: id present (uint8), id (int64), offset of
the record (uint64), tokens in the shard before it (uint64), tokens (uint64).

Shards are written and read with ``pyarrow.fs`` (local or shared folders, HDFS,
object stores); the folder must be one that all executors see. A task writes
under a name of its own and renames when complete, so a task that runs twice
leaves one whole shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm.tokens import CACHE_ENTRIES, END_ID, default_tokenizer_path, encoder

MASK_DELTA = 0xA282EAD8  # fixed value of the masked-checksum format
_HEAD_BYTES, _TAIL_BYTES = 12, 4
_ENTRY = np.dtype([("present", "u1"), ("id", "<i8"), ("offset", "<u8"), ("start", "<u8"), ("tokens", "<u8")])
_BUFFER = 1 << 20


def masked_crc(data: bytes) -> int:
    """CRC-32 rotated right by 15 bits plus a constant, modulo 2^32."""
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record."""
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked_crc(size)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(stream) -> bytes:
    """The payload of the record at the stream's place; raises ValueError where a checksum or length fails."""
    head = stream.read(_HEAD_BYTES)
    if len(head) != _HEAD_BYTES:
        raise ValueError("record cut off in its head")
    size, crc = struct.unpack("<QI", head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("checksum of a record's length fails")
    payload, tail = stream.read(size), stream.read(_TAIL_BYTES)
    if len(payload) != size or len(tail) != _TAIL_BYTES or masked_crc(payload) != struct.unpack("<I", tail)[0]:
        raise ValueError("checksum of a record's payload fails")
    return payload


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                        tokenizer: str | None = None, end_id: int = END_ID, wide: bool = False,
                        entries: int = CACHE_ENTRIES) -> DataFrame:
    """Encode every whole text, append ``end_id``, write shards in ascending id order.

    Returns the manifest (also stored in ``folder``): ``shard, name, records,
    tokens``. Null texts are empty (one record with the end id alone); null ids
    come first; rows with the same id are each a record, ordered by a hash of
    their text. Payloads are uint16 unless ``wide`` (for vocabularies above 65,536;
    without it an id that does not fit raises ValueError). Ids of documents are integers. An
    empty table writes an empty manifest. Other columns are ignored.
    """
    path = tokenizer or default_tokenizer_path()
    width = "<u4" if wide else "<u2"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        enc, shard = encoder(path, entries), TaskContext.get().partitionId()
        own = f"{base}/.{uuid.uuid4().hex}"
        end, index, offset, tokens = struct.pack("<I", end_id), [], 0, 0
        out = None
        for batch in batches:
            for i, data in zip(batch["_id"], enc.ids_of(batch["_text"])):
                ids = np.frombuffer(data + end, "<u4")
                if not wide and int(ids.max()) > 0xFFFF:
                    raise ValueError(f"id {int(ids.max())} needs wide=True: it does not fit 16 bits")
                record = frame(ids.astype(width).tobytes())
                if out is None:
                    out = store.open_output_stream(own + ".rec", buffer_size=_BUFFER)
                out.write(record)
                index.append((not pd.isna(i), 0 if pd.isna(i) else int(i), offset, tokens, len(ids)))
                offset, tokens = offset + len(record), tokens + len(ids)
        if out is None:
            return
        out.close()
        with store.open_output_stream(own + ".idx", buffer_size=_BUFFER) as f:
            f.write(np.array(index, _ENTRY).tobytes())
        name = f"shard-{shard:06d}"
        for end_of_name in (".idx", ".rec"):
            store.move(own + end_of_name, f"{base}/{name}{end_of_name}")
        yield pd.DataFrame({"shard": [shard], "name": [name], "records": [len(index)], "tokens": [tokens]})

    store, base = _open(folder)
    store.create_dir(base, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    key = F.col("_id").asc_nulls_first()
    rows = rows.repartitionByRange(key).sortWithinPartitions(key, F.xxhash64("_text"))
    # The id travels as a nullable integer: pandas would turn longs with nulls into doubles.
    rows = rows.select(F.col("_id").cast("string").alias("_id"), "_text")
    manifest = rows.mapInPandas(write, "shard int, name string, records long, tokens long")
    manifest.write.parquet(f"{folder.rstrip('/')}/manifest")
    return docs.sparkSession.read.schema("shard int, name string, records long, tokens long").parquet(f"{folder.rstrip('/')}/manifest")


def read_token_records(spark: SparkSession, folder: str, wide: bool = False, id_col: str = "doc_id",
                       with_ids: bool = False) -> DataFrame:
    """Read every record back in file order, checking lengths, checksums and the index.

    Returns ``id_col, start`` (ids of all records before it), ``n_tokens`` and
    ``ids_crc32`` (of the ids as little-endian uint32), and with ``with_ids`` the
    ids. One task reads one shard record by record. What the driver gathers is
    one manifest row per shard.
    """
    width = "<u4" if wide else "<u2"
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        for batch in batches:
            for name, ahead in zip(batch["name"], batch["ahead"]):
                with store.open_input_stream(f"{base}/{name}.idx", buffer_size=_BUFFER) as f:
                    index = np.frombuffer(f.read(), _ENTRY)
                with store.open_input_stream(f"{base}/{name}.rec", buffer_size=_BUFFER) as f:
                    place, rows = 0, []
                    for e in index:
                        payload = unframe(f)
                        ids = np.frombuffer(payload, width).astype("<u4")
                        if place != e["offset"] or len(ids) != e["tokens"]:
                            raise ValueError(f"{name}: the index does not match the records")
                        place += _HEAD_BYTES + len(payload) + _TAIL_BYTES
                        row = [int(e["id"]) if e["present"] else None, int(ahead + e["start"]), len(ids), zlib.crc32(ids.tobytes())]
                        rows.append([*row, ids.astype("i8")] if with_ids else row)
                        if len(rows) >= 2000:
                            yield _frame(rows, schema)
                            rows = []
                    if f.read(1):
                        raise ValueError(f"{name}: bytes after the last indexed record")
                    if rows:
                        yield _frame(rows, schema)

    return _shards(spark, folder).mapInPandas(read, schema)


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0, wide: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Records in a seeded random order (``order``), fetched one by one through the offset index."""
    width = "<u4" if wide else "<u2"

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        for batch in batches:
            for name in batch["name"]:
                with store.open_input_stream(f"{base}/{name}.idx", buffer_size=_BUFFER) as f:
                    while block := f.read(_ENTRY.itemsize * 50_000):
                        yield pd.DataFrame({"name": name, "offset": np.frombuffer(block, _ENTRY)["offset"].astype("i8"),
                                            "present": np.frombuffer(block, _ENTRY)["present"] == 1, "id": np.frombuffer(block, _ENTRY)["id"]})

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        opened: dict = {}
        for batch in batches:
            rows = []
            for name, offset, present, i, order in zip(batch["name"], batch["offset"], batch["present"], batch["id"], batch["order"]):
                if name not in opened:
                    while len(opened) >= 64:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = store.open_input_file(f"{base}/{name}.rec")
                opened[name].seek(offset)
                rows.append([int(i) if present else None, int(order), np.frombuffer(unframe(opened[name]), width).astype("i8")])
            out = pd.DataFrame(rows, columns=[id_col, "order", "ids"])
            out[id_col] = out[id_col].astype("Int64")
            yield out

    index = _shards(spark, folder).mapInPandas(entries, "name string, offset long, present boolean, id long")
    index = index.withColumn("order", F.xxhash64("name", "offset", F.lit(seed))).repartitionByRange("order").sortWithinPartitions("order")
    return index.mapInPandas(fetch, f"`{id_col}` long, `order` long, ids array<long>")


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    manifest = spark.read.schema("shard int, name string, records long, tokens long").parquet(f"{folder.rstrip('/')}/manifest")
    rows = sorted(manifest.select("shard", "name", "tokens").collect())
    ahead = np.cumsum([0, *[r["tokens"] for r in rows]])
    names = [(r["name"], int(a)) for r, a in zip(rows, ahead)]
    return spark.createDataFrame(names, "name string, ahead long").repartition(max(1, len(names)))


def _frame(rows: list, schema: str) -> pd.DataFrame:
    names = [c.split()[0].strip("`") for c in schema.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    out[names[0]] = out[names[0]].astype("Int64")
    return out
