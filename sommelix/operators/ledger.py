"""Work by region that can be taken up again: what was done for the same input is not done once more.

A ledger has one row for each region: a digest of its input and of the parameters, and how it ended. Regions whose row is of the
same digest and completed are skipped; all others are computed together, in one job; regions that fail their checks end as
failed, with the reason, and do not hold up the others. Results and ledger are tables with versions, results first: a run that is
lost between them is done again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sommelix.operators.lineage import saved
from sommelix.operators.versions import Versions


def digests(inputs: DataFrame, region: str, parameters: dict) -> DataFrame:
    """(region, digest): of all rows of a region in any order, repeats counted, and of the parameters. Rows are added up where
    they lie, so a large region is not gathered."""
    text = F.to_json(F.struct(*[f"`{c}`" for c in sorted(inputs.columns)]), {"ignoreNullFields": "false"})
    halves = [F.sum(F.xxhash64(F.lit(salt), text).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    made = inputs.groupBy(region).agg(F.concat_ws(":", F.count("*").cast("string"), *halves).alias("rows"))
    return made.select(region, F.sha2(F.concat("rows", F.lit(json.dumps(parameters, sort_keys=True))), 256).alias("digest"))


def run_regions(
    inputs: DataFrame,
    region: str,
    results: Versions,
    ledger: Versions,
    compute: Callable[[DataFrame], DataFrame],
    faults: Callable[[DataFrame], DataFrame],
    parameters: dict | None = None,
) -> DataFrame:
    """(region, digest, status, error) of this run: ``computed``, ``skipped`` or ``failed``.

    ``compute`` makes result rows, with the region, of the inputs of the regions to do; ``faults`` gives (region, error) for
    those that must not be computed, of several errors the first in order counts. Failed regions are tried again by the next
    run. Regions that left the input leave results and ledger; a null region is a region."""
    wanted = saved(digests(inputs, region, parameters or {}))
    before, known = ledger.number(), ledger.current()
    done = wanted.limit(0).select(F.col(region).alias("_r"), F.col("digest").alias("_d"))
    if known is not None:
        done = known.where("status <> 'failed'").select(F.col(region).alias("_r"), F.col("digest").alias("_d"))
    marked = saved(wanted.join(done, F.col(region).eqNullSafe(F.col("_r")) & (F.col("digest") == F.col("_d")), "left"))
    todo = marked.where("_r IS NULL AND _d IS NULL").select(F.col(region).alias("_todo"))
    if todo.isEmpty():
        status = marked.select(region, "digest", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error"))
    else:
        pending = saved(inputs.join(todo, F.col(region).eqNullSafe(F.col("_todo")), "left_semi"))
        bad = saved(faults(pending).groupBy(F.col(region).alias("_bad")).agg(F.min("error").alias("error")))
        good = pending.join(bad, F.col(region).eqNullSafe(F.col("_bad")), "left_anti")
        made, old = compute(good), results.current()
        if old is not None:
            stay = marked.where("_d IS NOT NULL").select(F.col(region).alias("_stay"))
            made = old.join(stay, F.col(region).eqNullSafe(F.col("_stay")), "left_semi").unionByName(made)
        results.publish(made)
        how = F.when(F.col("_d").isNotNull(), "skipped").when(F.col("error").isNotNull(), "failed").otherwise("computed")
        status = marked.join(bad, F.col(region).eqNullSafe(F.col("_bad")), "left").select(region, "digest", how.alias("status"), "error")
    status = saved(status)
    ledger.publish(status, before)
    return status
