"""Arrays and texts as compressed bytes, for the operators that move them as few large rows."""

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def pack(values):
    """Bytes of an integer array: planes of equal bytes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True)


def unpack(data, size, dtype):
    width = np.dtype(dtype).itemsize
    if not size:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(data, size * width, codec=_CODEC), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(dtype).ravel()


def compressed(data, level=None):
    return pa.Codec(_CODEC, compression_level=level).compress(data, asbytes=True) if len(data) else b""


def decompressed(data, size):
    return pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""


def cuts(numbers):
    """Begin and end of the stretches of equal neighbours."""
    begins = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else []
    return zip(begins, np.append(begins[1:], len(numbers)))


def columns_of(schema, columns):
    types = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    arrays = [pa.array(columns.get(name, []), types[kind]) for name, kind in fields]
    return pa.table(arrays, names=[name for name, _ in fields])


TEXTS = "part bigint, n bigint, rows binary, ids binary, sizes binary, size bigint, data binary"


def batch_texts(batch, column):
    values = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def numbers_of(batch, column):
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def pack_texts(n_parts):
    """Texts by part, compressed together."""

    def run(batches):
        for batch in batches:
            rows, ids = numbers_of(batch, 0), numbers_of(batch, 1)
            data, offsets = batch_texts(batch, 2)
            part = rows % n_parts
            order = np.argsort(part, kind="stable")
            borders = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
            for a, b in zip(borders, np.append(borders[1:], len(order))):
                own = order[a:b]
                joined = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in own)
                arrays = (rows[own], ids[own], np.diff(offsets)[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part[own[0]]], pa.int64()),
                        pa.array([len(own)], pa.int64()),
                        *(pa.array([pack(x)], pa.binary()) for x in arrays),
                        pa.array([len(joined)], pa.int64()),
                        pa.array([compressed(joined)], pa.binary()),
                    ],
                    ["part", "n", "rows", "ids", "sizes", "size", "data"],
                )

    return run


def documents_of(table):
    """Ids, bytes and places of the documents of a part, in an order that only they decide."""
    rows, ids, texts = [], [], []
    for p in table.to_pylist():
        data = decompressed(p["data"], p["size"])
        sizes = unpack(p["sizes"], p["n"], np.int64)
        ends = np.cumsum(sizes)
        texts += [data[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
        rows.append(unpack(p["rows"], p["n"], np.int64))
        ids.append(unpack(p["ids"], p["n"], np.int64))
    rows, ids = np.concatenate(rows), np.concatenate(ids)
    order = np.lexsort((ids, rows))
    texts = [texts[i] for i in order.tolist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return ids[order], np.frombuffer(b"".join(texts), np.uint8), offsets
