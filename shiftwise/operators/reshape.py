"""Wide-to-long reshapes: slot un-pivot, delimited-list explode, embedded
payload unpack. All run inside the scan stage as generators (no shuffle)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"  # what Python's str.strip() removes for ASCII text


def slot_columns(prefix: str, n_slots: int, start: int = 1) -> list[str]:
    """``[prefix1, prefix2, ..., prefixN]``."""
    return [f"{prefix}{i}" for i in range(start, start + n_slots)]


def unpivot_slots(df: DataFrame, ids: Sequence[str], measures: Mapping[str, Sequence[str]],
                  base_ts: str | None = None, minutes: int = 15,
                  value_type: str = "double", slot_col: str = "slot",
                  slot_ts_col: str = "slot_ts") -> DataFrame:
    """Turn N slot columns per measure into N rows.

    ``measures`` maps an output name to its ordered slot columns, e.g.
    ``{"AHT": ["AHT1", ..., "AHT96"], "CallVolume": [...]}``. Slot *i* of every
    measure comes from the same input row, so measures are paired by position
    in one ``stack`` generator - no self join, no shuffle, and no per-row array
    of structs to build. Output: ``ids``, ``slot`` (1-based int), optionally
    ``slot_ts = base_ts + (slot - 1) * minutes``, measures.
    """
    names = list(measures)
    widths = {len(cols) for cols in measures.values()}
    if len(widths) != 1:
        raise ValueError("every measure needs the same number of slot columns")
    n = widths.pop()
    args = []
    for i in range(n):
        args.append(F.lit(i + 1))
        args += [F.col(measures[m][i]).cast(value_type) for m in names]
    keep = [*ids, *([base_ts] if base_ts and base_ts not in ids else [])]
    long = df.select(*keep, F.stack(F.lit(n), *args).alias(slot_col, *names))
    out = [*[F.col(c) for c in ids], F.col(slot_col)]
    if base_ts:
        out.append((F.col(base_ts) + F.make_dt_interval(
            F.lit(0), F.lit(0), ((F.col(slot_col) - 1) * minutes).cast("int"), F.lit(0))
        ).alias(slot_ts_col))
    out += [F.col(m) for m in names]
    return long.select(*out)


def explode_list(df: DataFrame, col: str, separator: str, alias: str,
                 regex: bool = False) -> DataFrame:
    """One row per piece of a delimited string. Pieces are not trimmed and
    empty pieces are kept; a NULL string yields no row. ``separator`` is a
    literal unless ``regex=True``."""
    pattern = separator if regex else "\\Q" + separator + "\\E"
    return df.withColumn(alias, F.explode(F.split(F.col(col), pattern)))


def unpack_payload(df: DataFrame, schema_col: str, payload_col: str,
                   keep: Sequence[str] = (), on_error: str = "raise") -> DataFrame:
    """Decode base64 CSV payloads held in a column into one row per data line.

    Per row: schema = schema text with spaces removed; text = base64-decoded
    UTF-8, outer whitespace stripped, split on ``\\n``; the first line is dropped
    when (spaces removed) it equals the schema; each line is split on ``,``
    and every value stripped. Output: ``keep`` columns, ``schema``, ``line_no``
    (0-based position in the payload), ``values`` array<string>,
    ``n_fields``, ``ragged`` (field count differs from schema width) and
    ``decode_error``.

    ``on_error="raise"`` fails the job on a NULL payload, malformed base64 or
    UTF-8, like the original parser; ``on_error="null"`` keeps such a payload as
    one row with ``decode_error = true`` and NULL line fields, so one bad file
    cannot stop a large run and is still visible. Everything is a column expression:
    payloads are unpacked in parallel on the executors, never on the driver.
    """
    payload = F.col(payload_col)
    if on_error == "raise":
        decoded = F.when(payload.isNull(), F.raise_error(F.lit(f"NULL payload in {payload_col}"))
                         ).otherwise(F.decode(F.unbase64(payload), "UTF-8"))
    elif on_error == "null":
        as_text = F.try_to_binary(payload, F.lit("base64")).cast("string")
        decoded = F.when(F.is_valid_utf8(as_text), as_text)
    else:
        raise ValueError("on_error must be 'raise' or 'null'")
    schema = F.replace(F.col(schema_col), F.lit(" "), F.lit(""))
    text = F.btrim(decoded, F.lit(_WS))
    staged = df.select(*keep, schema.alias("schema"),
                       decoded.isNull().alias("decode_error"),
                       F.split(text, "\n").alias("__lines"))
    header = F.replace(F.get(F.col("__lines"), 0), F.lit(" "), F.lit("")) == F.col("schema")
    explode = F.posexplode_outer if on_error == "null" else F.posexplode
    lines = staged.select(*keep, "schema", "decode_error",
                          F.coalesce(header, F.lit(False)).alias("__hdr"),
                          explode("__lines").alias("line_no", "__line"))
    values = F.transform(F.split(F.col("__line"), ","), lambda v: F.btrim(v, F.lit(_WS)))
    width = F.size(F.split(F.col("schema"), ","))
    keep_line = ~(F.col("__hdr") & (F.col("line_no") == 0)) | F.col("decode_error")
    return (lines.filter(keep_line)
            .select(*keep, "schema", F.col("line_no").cast("int").alias("line_no"),
                    values.alias("values"), "decode_error")
            .withColumn("n_fields", F.size("values"))
            .withColumn("ragged", F.col("n_fields") != width)
            .select(*keep, "schema", "line_no", "values", "n_fields", "ragged", "decode_error"))


def project_schema(long_df: DataFrame, schema: str, types: Mapping[str, str] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Rows of one schema as named columns: field *i* of ``values`` becomes the
    *i*-th schema name, ``try_cast`` to ``types[name]`` when given (bad text ->
    NULL). Missing fields of ragged lines are NULL."""
    types = dict(types or {})
    norm = schema.replace(" ", "")
    names = norm.split(",")
    cols = []
    for i, name in enumerate(names):
        v = F.get(F.col("values"), i)
        cols.append((v.try_cast(types[name]) if name in types else v).alias(name))
    return long_df.filter(F.col("schema") == F.lit(norm)).select(*keep, *cols)
