"""Fill-in-the-middle: texts cut at two places into prefix, middle and suffix, and put together for training in another order.

A text is its UTF-8 bytes. ``bytes.translate`` maps each byte to a binary digit that tells whether it is of a class; the digits, read as
one big integer, are a mask with a bit per byte. Shifts and boolean operations on masks mark the last byte of every unit, ``bit_count`` says
how many units there are, and the place of the r-th mark is found by halving the mask: the count of the lower half tells in which half
it lies. All steps are linear in the text and no character becomes a Python object.

Units are code points, words (with the white space after them; white space before the first belongs to it) or lines (with their
``\\n``). Forms: ``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle, with the three sentinels; ``plain`` is the
text as it is. A text that is empty or holds a sentinel stays plain, so that every output can be taken apart again. All draws come from
the SHA-256 of the seed and the row's id: a row has the same result wherever and however often it is computed.

Cases: a null text counts as empty. A null id draws as the empty string. Rows that repeat stay rows of their own with equal results. Very long texts are
whole in one task, at some three times their bytes. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.work import slices

#: Beginnings of prefix, suffix and middle.
SENTINELS = (b"<P>", b"<S>", b"<M>")
#: Of 100 texts, how many are rearranged, and of 100 of these, how many in the order suffix, prefix, middle.
RATE, SPM_RATE = 90, 20
SEED = "1"

_SPACES = frozenset(b"\t\n\v\f\r ")


def _class(members) -> bytes:
    """A table for bytes.translate: digit 1 for the class, 0 for all others."""
    return bytes(ord("1") if b in members else ord("0") for b in range(256))


_CONTINUES = _class(range(0x80, 0xC0))
_WORD = _class(frozenset(range(256)) - _SPACES)
_NEWLINE = _class(b"\n")


def mask(data: bytes, table: bytes) -> int:
    """Bit i is set if byte i is of the table's class."""
    return int(data.translate(table)[::-1], 2) if data else 0


def unit_ends(data: bytes, unit: str = "char") -> int:
    """Bit i is set if a unit ends with byte i. Every byte belongs to a unit."""
    if not data:
        return 0
    last = 1 << (len(data) - 1)
    if unit == "char":
        return ~(mask(data, _CONTINUES) >> 1) & ((last << 1) - 1) | last
    if unit == "line":
        return mask(data, _NEWLINE) | last
    if unit != "word":
        raise ValueError(f"no such unit: {unit}")
    word = mask(data, _WORD)
    begins = word & ~(word << 1)
    return (begins & (begins - 1)) >> 1 | last  # the first word begins no new unit


def select(bits: int, width: int, rank: int) -> int:
    """The place of the set bit number ``rank``, from 1, of a mask of ``width`` bits."""
    base = 0
    while width > 1:
        half = width >> 1
        low = bits & ((1 << half) - 1)
        n = low.bit_count()
        if rank <= n:
            bits, width = low, half
        else:
            bits, width, base, rank = bits >> half, width - half, base + half, rank - n
    return base


def cut(data: bytes, ends: int, units: int) -> int:
    """The number of bytes that the first ``units`` units have."""
    return select(ends, len(data), units) + 1 if units else 0


def draws(seed: str, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def arrange(data: bytes, h: list[int], unit: str = "char", rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix, units of the middle, output)."""
    ends = unit_ends(data, unit)
    n = ends.bit_count()
    if not data or h[2] % 100 >= rate or any(s in data for s in SENTINELS):
        return n, "plain", None, None, data
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    i, j = cut(data, ends, a), cut(data, ends, b)
    prefix, middle, suffix = data[:i], data[i:j], data[j:]
    p, s, m = SENTINELS
    if h[3] % 100 < spm_rate:
        return n, "spm", a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def put_back(form: str, output: bytes) -> bytes:
    """The text of which ``output`` was made. No sentinel stands in a part, and none can begin in one and end in the next."""
    if form == "plain":
        return output
    p, s, m = SENTINELS
    first, second = (p, s) if form == "psm" else (s, p)
    if not output.startswith(first):
        raise ValueError(f"not the output of form {form}")
    one, found, rest = output[len(first) :].partition(second)
    two, also, middle = rest.partition(m)
    if not (found and also):
        raise ValueError(f"not the output of form {form}")
    return b"".join((one, middle, two) if form == "psm" else (two, middle, one))


def _transform(seed: str, unit: str, rate: int, spm_rate: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids = batch.column("doc_id").to_pylist()
            rows = [arrange(data, draws(seed, d), unit, rate, spm_rate) for d, data in zip(ids, batch.column("data").to_pylist())]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    return run


def transform(docs: DataFrame, unit: str = "char", rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) for every row; output is the text to train on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    schema = "doc_id long, n long, form string, prefix_units long, middle_units long, output binary"
    return rows.mapInArrow(_transform(seed, unit, rate, spm_rate), schema).withColumn("output", F.col("output").cast("string"))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        texts = [put_back(f, x) for f, x in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist())]
        yield batch.append_column("restored", pa.array(texts, pa.binary()))


def restore(transformed: DataFrame) -> DataFrame:
    """The rows with ``restored``, the text that ``output`` and ``form`` alone give back."""
    names = ", ".join(f"`{re.sub('`', '``', f.name)}` {'binary' if f.name == 'output' else f.dataType.simpleString()}" for f in transformed.schema)
    rows = transformed.withColumn("output", F.col("output").cast("binary")).mapInArrow(_restore, f"{names}, restored binary")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("output", "restored")})
