"""Ordered passes over per-block records.

Some folds need, at each block of rows, a state that depends on all blocks before it. If a
block's *effect* on the state can be described on its own, and effects can be combined, then
no task has to see more than one run of blocks: runs are combined in parallel, one short
record per run goes by in order, and inside each run the states follow in parallel again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCKS_PER_RUN = 1024


def ordered_pass(
    records: DataFrame,
    key: list[str],
    order: str,
    schema: StructType,
    begin: Callable[[dict], object],
    visit: Callable[[object, dict], tuple[object, tuple | None]],
    finish: Callable[[object], tuple] | None = None,
) -> DataFrame:
    """Visit the records of each key in order, with a state, streaming.

    ``begin`` gives the state before the first record of a key; ``visit`` the next state,
    and a row or None; ``finish`` a row at the end of a key. Rows follow ``schema`` after
    the key columns.
    """
    out_schema = StructType([*[records.schema[k] for k in key], *schema.fields])
    arrow = to_arrow_schema(out_schema)

    def run(batches):
        import pyarrow as pa

        def batch_of(rows):
            columns = list(zip(*rows)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        current, state = None, None
        for batch in batches:
            rows = []
            for record in batch.to_pylist():
                at = tuple(record[k] for k in key)
                if at != current:
                    if current is not None and finish is not None:
                        rows.append((*current, *finish(state)))
                    current, state = at, begin(record)
                state, row = visit(state, record)
                if row is not None:
                    rows.append((*at, *row))
            yield batch_of(rows)
        if current is not None and finish is not None:
            yield batch_of([(*current, *finish(state))])

    return (
        records.repartition(*key).sortWithinPartitions(*key, order).mapInArrow(run, out_schema)
    )


def states_before(
    records: DataFrame,
    key: list[str],
    effect: list[str],
    states: StructType,
    first: tuple,
    apply: Callable[[tuple, dict], tuple],
    identity: object,
    combine: Callable[[object, dict], object],
    combined: Callable[[object], tuple],
    blocks_per_run: int = BLOCKS_PER_RUN,
) -> DataFrame:
    """``(at, *states)``: the state before each block, ``at`` the struct of key and block.

    ``apply(state, record)`` is the state after a record. ``combine`` adds a record to an
    accumulated effect, from ``identity`` on, and ``combined`` gives its ``effect`` columns.
    """
    in_runs = records.withColumn("run", F.floor(F.col("block") / blocks_per_run))
    run_key = [*key, "run"]
    effects = StructType([records.schema[c] for c in effect])
    block = StructType([in_runs.schema["block"]])

    def apply_and_tell_block(state, record):
        return apply(state, record), (record["block"], *state)

    runs = ordered_pass(
        in_runs,
        run_key,
        "block",
        effects,
        begin=lambda record: identity,
        visit=lambda total, record: (combine(total, record), None),
        finish=combined,
    )
    # The state before each run, its run number first.
    run_states = ordered_pass(
        runs.withColumn("block", F.col("run")),
        key,
        "block",
        StructType([*block.fields, *states.fields]),
        begin=lambda record: first,
        visit=apply_and_tell_block,
    ).select(F.struct(*key, F.col("block").alias("run")).alias("at"), *states.names)
    with_start = in_runs.withColumn("at", F.struct(*run_key)).join(run_states, "at")
    names = states.names
    before = ordered_pass(
        with_start.drop("at"),
        run_key,
        "block",
        StructType([*block.fields, *states.fields]),
        begin=lambda record: tuple(record[name] for name in names),
        visit=apply_and_tell_block,
    )
    return before.select(F.struct(*key, "block").alias("at"), *names)
