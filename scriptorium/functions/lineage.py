"""Lineage values: ``ARRAY<STRUCT<stage, likeness>>`` built and read with array HOFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lineage stages in rank order (position = priority, 1-based).
LINEAGE_STAGES = (
    "audio_original",
    "transcript_raw",
    "transcript_structured",
    "transcript_cleaned",
)
UNPROCESSED_STAGE = "audio_original"
SCORED_STAGE = "transcript_structured"

LINEAGE_ITEM = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("likeness", T.DoubleType()),
])
LINEAGE_TYPE = T.ArrayType(LINEAGE_ITEM)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stages_array(stages: Sequence[str] = LINEAGE_STAGES) -> Column:
    return F.array(*[F.lit(s) for s in stages])


def build_lineage(
    selected_stage: Column | str,
    likeness: Column | str | None = None,
    stages: Sequence[str] = LINEAGE_STAGES,
) -> Column:
    """Stages up to and including the selected one.

    The (4-place, half-even) likeness is attached to the scored stage only when
    that stage is the selected one; an unknown stage gives ``[stage]`` and no
    selection gives ``[audio_original]``.
    """
    sel = _c(selected_stage)
    lk = F.lit(None).cast("double") if likeness is None else _c(likeness)
    arr = stages_array(stages)
    pos = F.array_position(arr, sel)
    kept = F.slice(arr, F.lit(1), pos.cast("int"))
    items = F.transform(
        kept,
        lambda s: F.struct(
            s.alias("stage"),
            F.when((s == F.lit(SCORED_STAGE)) & (sel == F.lit(SCORED_STAGE)), F.bround(lk, 4))
            .cast("double").alias("likeness"),
        ),
    )
    bare = lambda name: F.array(F.struct(name.alias("stage"), F.lit(None).cast("double").alias("likeness")))
    return (
        F.when(sel.isNull(), bare(F.lit(UNPROCESSED_STAGE)))
        .when(pos == 0, bare(sel))
        .otherwise(items)
        .cast(LINEAGE_TYPE)
    )


def lineage_stage_number(lineage: Column | str, stages: Sequence[str] = LINEAGE_STAGES) -> Column:
    """1-based rank of the last lineage stage; 0 when empty, null or unknown."""
    lin = _c(lineage)
    last = F.element_at(lin, -1).getField("stage")
    return (
        F.when(F.coalesce(F.size(lin), F.lit(0)) <= 0, F.lit(0))
        .otherwise(F.coalesce(F.array_position(stages_array(stages), last), F.lit(0)))
        .cast("int")
    )


def lineage_json(lineage: Column | str) -> Column:
    """Heterogeneous JSON list: a bare string when likeness is null, else an object
    ``{"likeness": x, "stage": s}`` with keys sorted."""
    lin = _c(lineage)
    items = F.transform(
        lin,
        lambda x: F.when(
            x.getField("likeness").isNull(), _quoted(x.getField("stage"))
        ).otherwise(
            F.concat(F.lit('{"likeness":'), _py_float(x.getField("likeness")), F.lit(',"stage":'),
                     _quoted(x.getField("stage")), F.lit("}"))
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _py_float(v: Column) -> Column:
    """A 4-place likeness as Python's ``repr`` writes it.  Java switches to
    scientific notation below 1e-3 (``5.0E-4``); Python keeps ``0.0005``."""
    j = F.to_json(F.array(v))
    plain = j.substr(F.lit(2), F.length(j) - F.lit(2))
    return F.when((v > 0) & (v < 0.001), F.format_string("%.4f", v)).otherwise(plain)


def _quoted(s: Column) -> Column:
    """JSON string literal; ``to_json`` of a one-element array does the escaping."""
    j = F.to_json(F.array(s))
    return j.substr(F.lit(2), F.length(j) - F.lit(2))
