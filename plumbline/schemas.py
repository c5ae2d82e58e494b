"""Declared schemas of the nested sheet documents; nothing is inferred from JSON."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


BOX = T.ArrayType(_D)
SHEET_INFO = _struct(
    title=_S, chainage_from=_S, chainage_to=_S, drawing_no=_S, sheet_no=_S, scale=_S, date=_S, previous_sheet=_S, next_sheet=_S, client=_S, project=_S,
    issue_record=T.ArrayType(_struct(no=_S, date=_S, rev=_S)), stations=T.ArrayType(_struct(name=_S, side=_S)),
)
BRIDGE = _struct(bridge_id=_S, existing_type=_S, existing_span=_S, crossing=_S, proposal=_S, category=_S, chainage_m=_D, levels=T.MapType(_S, _D), text=_S)
COLUMN = _struct(chainage=_D, x=_D, values=T.MapType(_S, _D), checks_ok=T.BooleanType())
CURVE = _struct(curve_no=_S, line=_S, location=_S, params=T.MapType(_S, _S))
#: ``bands`` may be a table, an error or absent in the source: the error is a column of its own.
SHEET = _struct(
    file=_S, page=_I, sheet_info=SHEET_INFO, lines=T.MapType(_S, _S), bands_error=_S, columns=T.ArrayType(COLUMN), bridges=T.ArrayType(BRIDGE), curves=T.ArrayType(CURVE),
    notes=T.ArrayType(_struct(no=_I, text=_S)), abbreviations=T.MapType(_S, _S), texts=T.ArrayType(_struct(text=_S, bbox=BOX)),
)
