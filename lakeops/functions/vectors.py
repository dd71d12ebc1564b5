"""Vector columns (``array<float>``): parsing, checks, signed element-wise sums and summaries.

All arithmetic is written with higher-order functions (``transform``, ``zip_with``, ``aggregate``), which
run in the JVM on each row; element values are widened to double before they are added. Raw bytes are
the one input without a built-in reader; an Arrow function takes a whole batch of them at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OK = "OK"
# What counts as a number in vector text.
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_vector(n: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), n)


def parse_vector_text(column: str | Column, n: int, sep: str = ",") -> Column:
    """Comma text to ``array<float>``. A null text, or any element that is not a number, gives a zero
    vector of length ``n`` (the length check comes after, see :func:`length_status`)."""
    text = _c(column)
    number = lambda x: F.when(x.rlike(NUMBER), x.try_cast("float"))  # noqa: E731  the cast alone also takes "1.0f"
    parsed = F.transform(F.split(text, sep, -1), number)
    usable = lambda v: v.isNotNull() & ~F.exists(v, lambda x: x.isNull())
    # Through an array of one, so that the parse itself stands in the expression only once.
    return F.transform(F.array(parsed), lambda v: F.when(usable(v), v).otherwise(zero_vector(n)))[0]


def vector_text(column: str | Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(_c(column), lambda x: x.cast("string")), sep)


def length_status(column: str | Column, n: int, label: Column | None = None) -> Column:
    """``OK`` when the vector has ``n`` elements, else an error text for that row."""
    v = _c(column)
    what = label if label is not None else F.lit("vector")
    size = F.coalesce(F.size(v), F.lit(0))
    return F.when(v.isNotNull() & (size == F.lit(n)), F.lit(OK)).otherwise(
        F.concat(F.lit(f"Error: expected {n} values in "), what, F.lit(", found "), size.cast("string")))


def to_double(column: str | Column) -> Column:
    return F.transform(_c(column), lambda x: x.cast("double"))


def signed_sum(columns: Sequence[str | Column], n_added: int) -> Column:
    """Element-wise: the first ``n_added`` vectors added, the rest subtracted (in double)."""
    vecs = [to_double(c) for c in columns]
    out = vecs[0]
    for i, v in enumerate(vecs[1:], start=1):
        if i < n_added:
            out = F.zip_with(out, v, lambda a, b: a + b)
        else:
            out = F.zip_with(out, v, lambda a, b: a - b)
    return out


def vector_sum(column: str | Column) -> Column:
    return F.aggregate(_c(column), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def vector_max(column: str | Column) -> Column:
    return F.array_max(_c(column))


def split_vector(column: str | Column, parts: int, size: int) -> list[Column]:
    v = _c(column)
    return [F.slice(v, 1 + i * size, size) for i in range(parts)]


def vector_parser(kind: str, n: int | None = None):
    """The replaceable payload parser: ``"text"`` (comma text) or ``"float32"`` (raw little-endian
    bytes). A null or unreadable payload becomes a zero vector of length ``n``. Pickled payloads are refused:
    loading one runs code."""
    if kind in ("text", "float32") and n is None:
        raise ValueError("a parser needs the vector length n")
    if kind == "text":
        return lambda c: parse_vector_text(c, n)
    if kind == "float32":
        return lambda c: F.coalesce(float32_from_bytes(_c(c)), zero_vector(n))
    if kind == "pickle":
        raise ValueError("pickled payloads are refused: loading one runs code")
    raise ValueError(f"unknown vector format {kind!r}")


@F.arrow_udf(T.ArrayType(T.FloatType()))
def float32_from_bytes(blobs: pa.Array) -> pa.Array:
    """Raw little-endian float32 bytes to a vector: the bytes of a whole Arrow batch are taken as one float buffer;
    null for null bytes or a length that is no multiple of 4."""
    good = pc.fill_null(pc.equal(pc.bit_wise_and(pc.binary_length(blobs), 3), 0), False)
    whole = pc.if_else(good, blobs, pa.scalar(b"", pa.binary())).cast(pa.large_binary())
    ends = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8)
    data = whole.buffers()[2]
    values = np.frombuffer(data, "<f4", (ends[-1] - ends[0]) // 4, ends[0]) if data is not None and len(whole) else np.empty(0, "<f4")
    return pa.ListArray.from_arrays(pa.array(((ends - ends[0]) // 4).astype(np.int32)), pa.array(values.astype(np.float32)), mask=pc.invert(good))


@F.arrow_udf(T.BinaryType())
def float32_to_bytes(vectors: pa.Array) -> pa.Array:
    """The inverse (null elements become NaN): a whole Arrow batch's elements are taken as one byte buffer."""
    known = vectors.is_valid()
    vectors = pc.if_else(known, vectors, pa.scalar([], vectors.type))
    sizes = np.r_[0, np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False))].astype(np.int64) if len(vectors) else np.zeros(1, np.int64)
    flat = pc.fill_null(vectors.flatten().cast(pa.float32()), float("nan")).to_numpy(zero_copy_only=False).astype("<f4")
    out = pa.Array.from_buffers(pa.large_binary(), len(vectors), [None, pa.py_buffer(sizes * 4), pa.py_buffer(np.ascontiguousarray(flat))])
    return pc.if_else(known, out.cast(pa.binary()), pa.scalar(None, pa.binary()))
