"""Proof that a paged listing has landed whole: the chain of next links of each listing is followed to its end.

Pages are rows (listing, page, next): ``next`` names the page that follows, null on the last one. A listing is whole if
its first page is there, every link leads to a landed page, no page landed twice, and following the links from the first
page comes to the last one through all pages. Links are followed by doubling: after r rounds a page knows the one 2^r
links ahead and whether the end was reached, so a listing of a million pages takes twenty joins, and a loop shows as
pages that never come to an end. Links that meet (two pages naming the same next one) leave some page unreachable from
the first, as a second chain does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import ensure_checkpoint_dir

COMPLETE = "complete"
# What is wrong, the first that holds: (status, column that counts it).
FAULTS = (("no first page", "n_no_first"), ("page landed twice", "n_repeated"), ("gap", "n_gaps"), ("loop", "n_looping"), ("page off the chain", "n_off_chain"))


def _followed(pages: DataFrame, longest: int) -> DataFrame:
    """(listing, page, to, steps): where each page's chain ends (null: at the end; else at a missing page or in a loop)
    and after how many pages."""
    state = pages.select("listing", "page", F.col("next").alias("to"), F.lit(1).cast("long").alias("steps")).checkpoint()
    for _ in range(max(1, longest).bit_length()):
        ahead = state.select(F.col("listing").alias("_l"), F.col("page").alias("_p"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        known = state.join(ahead, (F.col("listing") == F.col("_l")) & (F.col("to") == F.col("_p")), "left")
        state = known.select("listing", "page", F.when(F.col("_p").isNotNull(), F.col("_to")).otherwise(F.col("to")).alias("to"),
                             (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")).checkpoint()
    return state


def check_listings(pages: DataFrame, listing: str, page: str, next_page: str, first: Column) -> DataFrame:
    """Per listing: ``n_pages`` (distinct), the counts of :data:`FAULTS`, and ``status``. ``first`` tells the first page
    of a listing from its columns. Rows without a listing or page name nothing and are left out."""
    ensure_checkpoint_dir(pages.sparkSession)
    landed = pages.where(F.col(listing).isNotNull() & F.col(page).isNotNull()).select(
        F.col(listing).alias("listing"), F.col(page).alias("page"), F.col(next_page).alias("next"), F.coalesce(first, F.lit(False)).alias("first"))
    # Copies of a page are one page with one link (the smallest, if they differ), and counted as repeated.
    one = landed.groupBy("listing", "page").agg(F.min("next").alias("next"), F.bool_or("first").alias("first"), F.count(F.lit(1)).alias("copies")).checkpoint()
    longest = one.groupBy("listing").count().agg(F.max("count")).first()[0] or 0
    names = one.select(F.col("listing").alias("_l"), F.col("page").alias("_p"))
    gaps = one.join(names, (F.col("listing") == F.col("_l")) & (F.col("next") == F.col("_p")), "left_anti").where(F.col("next").isNotNull()).groupBy("listing").agg(F.count(F.lit(1)).alias("n_gaps"))
    ends = _followed(one, longest).join(names.withColumn("_there", F.lit(True)), (F.col("listing") == F.col("_l")) & (F.col("to") == F.col("_p")), "left")
    # A chain that still leads to a landed page after more links than there are pages never ends.
    walked = ends.select(F.col("listing").alias("l"), F.col("page").alias("p"), "steps", F.col("_there").isNotNull().alias("loops"))
    per_page = one.join(walked, (F.col("listing") == F.col("l")) & (F.col("page") == F.col("p")))
    per = per_page.groupBy("listing").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if("first").alias("_n_first"), F.sum(F.col("copies") - 1).alias("n_repeated"),
        F.count_if("loops").alias("n_looping"), F.max(F.when(F.col("first") & ~F.col("loops"), F.col("steps"))).alias("_reached"))
    counted = per.join(gaps, "listing", "left").select(
        "listing", "n_pages", (F.col("_n_first") == 0).cast("long").alias("n_no_first"), "n_repeated", F.coalesce("n_gaps", F.lit(0).cast("long")).alias("n_gaps"),
        "n_looping", F.greatest(F.col("n_pages") - F.coalesce("_reached", F.lit(0).cast("long")), F.lit(0).cast("long")).alias("n_off_chain"))
    status = F.lit(COMPLETE)
    for name, count in reversed(FAULTS):
        status = F.when(F.col(count) > 0, F.lit(name)).otherwise(status)
    return counted.withColumn("status", status)
