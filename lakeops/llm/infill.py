"""Fill-in-middle transformation of documents by displacement scatter.

A text is cut twice between its units and its parts are dealt out anew around sentinels. All texts of a batch are
one byte buffer: unit starts are found in it at once, the two cuts of every text become byte positions, and a
difference array gets, at each text's begin, cuts and end, by how much the bytes from there on move. Its running
sum is every byte's displacement, and one scatter writes all outputs. :func:`restore` reads the sentinels of the
outputs, builds the displacement of every byte of the texts in the same way, and gathers the texts back.

Which cuts and which form a text gets depends on its id and its number of units only, so a task that runs again
gives the same bytes. Rows are independent: no shuffle, and memory follows ``GROUP_BYTES`` or the longest text.

Defined cases: a null text is empty; an empty text, a text that holds a sentinel, and the texts that the hash leaves
whole keep the form ``plain`` (cuts null, output the text itself); a null id hashes like an empty one; repeated
rows and ids are transformed alike; other columns pass through, names that clash with the result raise
``ValueError``; empty tables give empty results. An output that is not of its form is restored as null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm import textbytes as tb

#: The sentinels, the forms and their order of parts, and the shares of the contract.
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM])
MARK = 3
KEEP_SHARE, SPM_SHARE = 90, 20
SALT = "1:"

GROUP_BYTES = 8 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column in one byte buffer, and where each begins (and the last ends)."""
    texts = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return data, ends - ends[0]


def _column(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Texts of a byte buffer as an Arrow column."""
    return pa.Array.from_buffers(pa.large_string(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def _marks(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sentinels stand (wholly inside one text), and in which text."""
    at = np.flatnonzero(data[:-2] == ord("<")) if len(data) >= MARK else np.empty(0, np.int64)
    at = at[(data[at + 2] == ord(">")) & np.isin(data[at + 1], [ord(c) for c in SENTINELS])]
    text = np.searchsorted(begins, at, side="right") - 1
    whole = at + MARK <= begins[text + 1]
    return at[whole], text[whole]


def _displacement(size: int, places: list[np.ndarray], shifts: list[np.ndarray]) -> np.ndarray:
    """Running sum of a difference array: from ``places[k]`` on, bytes move by ``shifts[k]`` (places ascend per text)."""
    step = np.zeros(size + 1, np.int64)
    before = 0
    for place, shift in zip(places, shifts):
        np.add.at(step, place, shift - before)
        before = shift
    # Each text starts anew: take back the last shift of the text before it.
    np.add.at(step, places[0][1:], -shifts[-1][:-1])
    return np.cumsum(step[:size])


def draws(doc_ids: list) -> np.ndarray:
    """The four unsigned numbers of each id, one row per id."""
    raw = b"".join(hashlib.sha256(f"{SALT}{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def displace(data: np.ndarray, begins: np.ndarray, h: np.ndarray, keep_share: int = KEEP_SHARE, spm_share: int = SPM_SHARE):
    """Outputs of all texts: (bytes, where each output begins, form numbers, n, prefix and middle code points)."""
    texts, size = len(begins) - 1, len(data)
    lead = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    joined = np.zeros(size, bool)
    joined[1:] = letter[1:] & letter[:-1]
    joined[begins[:-1][begins[:-1] < size]] = False
    starts = np.flatnonzero(lead & ~joined)
    first = np.searchsorted(starts, begins)
    n = np.diff(first)
    cut1, cut2 = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    at = np.append(starts, size)  # the end of a text is the start of the next one's first unit, or the end of all
    a, b = (at[first[:-1] + c] for c in (np.minimum(cut1, cut2), np.maximum(cut1, cut2)))

    length = np.diff(begins)
    marked = np.zeros(texts, bool)
    marked[_marks(data, begins)[1]] = True
    form = np.where((length == 0) | marked | (h[:, 2] % 100 >= keep_share), 0, np.where(h[:, 3] % 100 < spm_share, 2, 1))
    plain, spm = form == 0, form == 2

    out_begins = np.r_[0, np.cumsum(length + np.where(plain, 0, 3 * MARK))]
    start, end = begins[:-1], begins[1:]
    prefix, middle, suffix = a - start, b - a, end - b
    move = out_begins[:-1] - start
    shifts = [np.where(plain, 0, np.where(spm, 2 * MARK + suffix, MARK)),
              np.where(plain, 0, 3 * MARK + suffix),
              np.where(plain, 0, np.where(spm, MARK - prefix - middle, 2 * MARK - middle))]
    shift = _displacement(size, [start, a, b], [move + s for s in shifts])
    out = np.empty(out_begins[-1], np.uint8)
    out[np.arange(size) + shift] = data
    base = out_begins[:-1]
    spots = {"P": np.where(spm, base + MARK + suffix, base), "S": np.where(spm, base, base + MARK + prefix),
             "M": base + 2 * MARK + prefix + suffix}
    for name, spot in spots.items():
        for k, byte in enumerate(SENTINELS[name]):
            out[spot[~plain] + k] = byte

    points = np.r_[0, np.cumsum(lead)]
    return out, out_begins, form, n, points[a] - points[start], points[b] - points[a]


def gather_back(data: np.ndarray, begins: np.ndarray, form: np.ndarray):
    """Texts of all outputs: (bytes, where each text begins, which outputs were of their form)."""
    texts = len(begins) - 1
    at, owner = _marks(data, begins)
    cut = form > 0
    count = np.bincount(owner, minlength=texts)
    good = (form == 0) | (cut & (count == 3))
    use = (cut & (count == 3))[owner]
    rows = at[use].reshape(-1, 3)
    which = np.flatnonzero(cut & (count == 3))
    kind = data[rows + 1]
    wanted = np.where((form[which] == 2)[:, None], np.frombuffer(b"SPM", np.uint8), np.frombuffer(b"PSM", np.uint8))
    right = (kind == wanted).all(axis=1) & (rows[:, 0] == begins[which])
    good[which[~right]] = False
    rows, which = rows[right], which[right]

    start, end = begins[:-1].copy(), begins[1:]
    length = np.where(good, np.diff(begins), 0)
    length[which] -= 3 * MARK
    back = np.r_[0, np.cumsum(length)]
    prefix, suffix = np.where(good, length, 0), np.zeros(texts, np.int64)
    spm = form[which] == 2
    one, two = rows[:, 1] - rows[:, 0] - MARK, rows[:, 2] - rows[:, 1] - MARK
    prefix[which], suffix[which] = np.where(spm, two, one), np.where(spm, one, two)
    middle = length - prefix - suffix
    move = start - back[:-1]
    add = [np.zeros(texts, np.int64) for _ in range(3)]
    add[0][which] = np.where(spm, 2 * MARK + one, MARK)
    add[1][which] = (3 * MARK + suffix[which])
    add[2][which] = np.where(spm, MARK - (prefix + middle)[which], 2 * MARK - middle[which])
    place = [back[:-1], back[:-1] + prefix, back[:-1] + prefix + middle]
    shift = _displacement(int(back[-1]), place, [move + s for s in add])
    return data[np.arange(back[-1]) + shift], back, good


def _check(df: DataFrame, new: set[str]) -> None:
    if new & set(df.columns):
        raise ValueError(f"columns named {', '.join(sorted(new & set(df.columns)))} would clash with the result")


def transform(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_share: int = KEEP_SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``df`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``. A share of ``keep_share``
    percent of the texts is cut; of these, ``spm_share`` percent get the suffix first."""
    new = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    _check(df, {f.name for f in new})
    id_at, text_at = df.columns.index(doc_id), df.columns.index(text)

    def rows(batches):
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_pylist()
            for lo, hi in tb.groups(sizes, GROUP_BYTES):
                part = batch.slice(lo, hi - lo)
                data, begins = _buffer(part.column(text_at))
                out, out_begins, form, n, prefix, middle = displace(data, begins, draws(part.column(id_at).to_pylist()), keep_share, spm_share)
                plain = form == 0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n), pa.array(FORMS[form].tolist(), pa.string()), pa.array(prefix, mask=plain),
                     pa.array(middle, mask=plain), _column(out, out_begins)], [*part.schema.names, *[f.name for f in new]])

    return df.mapInArrow(rows, T.StructType([*df.schema.fields, *new]))


def restore(df: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``df`` with ``restored``: the exact text, from the output and its form alone."""
    _check(df, {"restored"})
    out_at, form_at = df.columns.index(output), df.columns.index(form)

    def rows(batches):
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(out_at)), 0).to_pylist()
            for lo, hi in tb.groups(sizes, GROUP_BYTES):
                part = batch.slice(lo, hi - lo)
                data, begins = _buffer(part.column(out_at))
                number = {name: i for i, name in enumerate(FORMS.tolist())}
                forms = np.array([number.get(f, -1) for f in part.column(form_at).to_pylist()], np.int64)
                text, back, good = gather_back(data, begins, forms)
                good &= ~part.column(out_at).is_null().to_numpy(zero_copy_only=False)
                restored = pa.compute.if_else(pa.array(good), _column(text, back), pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, restored], [*part.schema.names, "restored"])

    return df.mapInArrow(rows, T.StructType([*df.schema.fields, T.StructField("restored", T.StringType())]))
