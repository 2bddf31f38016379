"""Q19: the three-stage recommender training set with parquet hand-offs.

Stage 1 (common customers) writes the qualified customers and the staged
pairs; stage 2 reads the pairs and writes neighbour lists; stage 3 reads the
lists and writes the triples. Each stage reads the previous stage's written
output, which cuts the lineage: a lost executor or a failed later stage never
recomputes an earlier one, and a failed stage stops the rest (the exception
propagates). Row counts are observed during the writes, with no second job, and
kept in each folder's manifest together with its files; a stage refuses a source
folder that does not hold what its manifest says, or whose write never ended.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.customers import (
    common_customer_pairs,
    customer_purchases,
    customer_purchases_from_pairs,
    qualified_common_customers,
)
from revlens.operators.neighbours import edge_group_passes, edge_groups, neighbour_groups, neighbour_lists, pairs_of_groups
from revlens.operators.triples import (
    user_triple_counts,
    user_triple_counts_from_counted_pairs,
    user_triple_counts_from_pairs,
    user_triples,
    user_triples_from_pairs,
)
from revlens.sources.readers import (
    read_neighbour_lists,
    read_neighbour_pairs,
    read_pairs,
    read_purchases,
    read_reviews,
)
from revlens.sources.handoff import Workspace, check_source, write_stage
from revlens.sources.schemas import COUNTED_PAIR_SCHEMA

log = logging.getLogger(__name__)

# Output folder names of the three stages (fixed hand-off layout).
QUALIFIED_DIR = "part_2_1"
PAIRS_DIR = "stg"
PURCHASES_DIR = "stg_purchases"
STAGED_FORMATS = ("grid", "purchases")
LISTS_DIR = "part_2_2"
NEIGHBOUR_PAIRS_DIR = "part_2_2_pairs"
LIST_FORMATS = ("lists", "pairs")
TRIPLES_DIR = "part_2_3"
TRIPLE_COUNTS_DIR = "part_2_3_counts"
TRIPLE_USERS_DIR = "part_2_3_users"


@dataclass
class StageResult:
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def _write_counted(df: DataFrame | Sequence[DataFrame], path: str, name: str, num_files: int | None, result: StageResult) -> None:
    result.rows[name] = write_stage(df, path, num_files).rows
    result.paths[name] = path
    log.info("%s: %d rows written to %s", name, result.rows[name], path)


def _join(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def stage_common_customers(
    spark: SparkSession,
    books_path: str,
    music_path: str,
    out_dir: str,
    more_than_books: int | str = 4,
    more_than_music: int | str = 5,
    qualified_files: int | None = None,
    pairs_files: int | None = None,
    staged: str = "purchases",
) -> StageResult:
    """Stage 1: qualified customers (thresholds are strict) and the staged rows.

    Thresholds may arrive as strings from a job launcher; they become ints
    here. The staged rows for stage 2 are not filtered by the thresholds:
    ``staged="purchases"`` writes the purchases of every common customer, which
    grow linearly; ``"grid"`` writes the (book, music) pairs they are derived
    from, which grow with books x music per customer: for small inputs only.
    """
    if staged not in STAGED_FORMATS:
        raise ValueError(f"staged must be one of {STAGED_FORMATS}")
    books = read_reviews(spark, books_path)
    music = read_reviews(spark, music_path)
    result = StageResult()
    qualified = qualified_common_customers(books, music, int(more_than_books), int(more_than_music))
    _write_counted(qualified, _join(out_dir, QUALIFIED_DIR), "qualified", qualified_files, result)
    if staged == "grid":
        _write_counted(common_customer_pairs(books, music), _join(out_dir, PAIRS_DIR), "pairs", pairs_files, result)
    else:
        purchases = customer_purchases(books, music)
        _write_counted(purchases, _join(out_dir, PURCHASES_DIR), "purchases", pairs_files, result)
    return result


def stage_neighbours(
    spark: SparkSession,
    pairs_path: str,
    out_dir: str,
    lists_files: int | None = None,
    list_format: str = "pairs",
    staged: str = "purchases",
) -> StageResult:
    """Stage 2: purchases from the staged rows, neighbour edges, lists.

    ``staged`` names what stage 1 wrote: the pair grid, split back into
    purchases here, or the purchases themselves.

    ``list_format="pairs"`` writes (customer, neighbour, n_shared) rows, which no
    hot customer can grow into one huge row; ``"lists"`` writes the same multiset
    as one array per customer: only where no customer has many neighbours. The
    pairs bring their customer's number of neighbours (``n_neighbours``, NULL where
    its list came in parts), so stage 3 need not shuffle them to count it.
    """
    if list_format not in LIST_FORMATS:
        raise ValueError(f"list_format must be one of {LIST_FORMATS}")
    if staged not in STAGED_FORMATS:
        raise ValueError(f"staged must be one of {STAGED_FORMATS}")
    check_source(spark, pairs_path)
    if staged == "grid":
        purchases = customer_purchases_from_pairs(read_pairs(spark, pairs_path))
    else:
        purchases = read_purchases(spark, pairs_path)
    result = StageResult()
    if list_format == "lists":
        lists = neighbour_lists(edge_groups(purchases, limit=None))
        _write_counted(lists, _join(out_dir, LISTS_DIR), "lists", lists_files, result)
    else:
        own = F.when(F.col("parts") == 1, F.size("neighbours").cast("long"))
        with Workspace(spark, "buyers") as work:
            edges = edge_group_passes(purchases, passes=None if lists_files is None else 1, work=work)
            pairs = [pairs_of_groups(neighbour_groups(e).withColumn("n_neighbours", own), "n_neighbours") for e in edges]
            _write_counted(pairs, _join(out_dir, NEIGHBOUR_PAIRS_DIR), "neighbour_pairs", lists_files, result)
    return result


def stage_triples(
    spark: SparkSession,
    lists_path: str,
    out_dir: str,
    mode: str = "documented",
    expand: bool = False,
    triples_files: int | None = None,
    list_format: str = "pairs",
) -> StageResult:
    """Stage 3: triples (``expand``) or their exact factorised counts.

    Reads stage 2's lists or, with ``list_format="pairs"``, its long form.
    The expanded bag is quadratic in the number of users, and is for small
    inputs only. The counts are linear, and the users are written next to them:
    a user's triples are, for each of its positives ``n_positive`` times, all
    other users (documented: but its neighbours) as negatives, so the two tables
    and the neighbour pairs carry the whole bag.
    """
    if list_format not in LIST_FORMATS:
        raise ValueError(f"list_format must be one of {LIST_FORMATS}")
    check_source(spark, lists_path)
    if list_format == "lists":
        source = read_neighbour_lists(spark, lists_path)
        expanded, counted = user_triples, user_triple_counts
    else:
        source = read_neighbour_pairs(spark, lists_path)
        expanded, counted = user_triples_from_pairs, user_triple_counts_from_pairs
        if not expand and "n_neighbours" in spark.read.parquet(lists_path).columns:
            source, counted = spark.read.schema(COUNTED_PAIR_SCHEMA).parquet(lists_path), user_triple_counts_from_counted_pairs
    result = StageResult()
    if expand:
        _write_counted(expanded(source, mode), _join(out_dir, TRIPLES_DIR), "triples", triples_files, result)
    else:
        counts = counted(source, mode)
        _write_counted(counts, _join(out_dir, TRIPLE_COUNTS_DIR), "triple_counts", triples_files, result)
        written = spark.read.parquet(_join(out_dir, TRIPLE_COUNTS_DIR))
        _write_counted(written.select("user_id").distinct(), _join(out_dir, TRIPLE_USERS_DIR), "triple_users", None, result)
    return result


def build_training_set(
    spark: SparkSession,
    books_path: str,
    music_path: str,
    out_dir: str,
    more_than_books: int | str = 4,
    more_than_music: int | str = 5,
    mode: str = "documented",
    expand: bool = False,
    file_counts: dict[str, int] | None = None,
    list_format: str = "pairs",
    staged: str = "purchases",
) -> StageResult:
    """Run stages 1-3 in order; each reads what the one before wrote.

    Every hand-off is linear in the data; ``staged="grid"``,
    ``list_format="lists"`` and ``expand=True`` choose the quadratic formats.
    """
    files = file_counts or {}
    result = stage_common_customers(
        spark,
        books_path,
        music_path,
        out_dir,
        more_than_books,
        more_than_music,
        files.get("qualified"),
        files.get("pairs"),
        staged,
    )
    first_out = result.paths["pairs" if staged == "grid" else "purchases"]
    second = stage_neighbours(spark, first_out, out_dir, files.get("lists"), list_format, staged)
    handed = second.paths["lists" if list_format == "lists" else "neighbour_pairs"]
    third = stage_triples(spark, handed, out_dir, mode, expand, files.get("triples"), list_format)
    for stage in (second, third):
        result.paths.update(stage.paths)
        result.rows.update(stage.rows)
    return result


def main(argv: list[str] | None = None) -> StageResult:
    """Command line for spark-submit: run one stage or all three.

    ``spark-submit --py-files revlens.zip revlens/plans/training_set.py all --books B --music M --out O``
    (or ``python -m revlens.plans.training_set ...`` against a configured master).
    Thresholds arrive as strings, as job launchers pass them.
    """
    import argparse

    parser = argparse.ArgumentParser(prog="revlens.plans.training_set")
    parser.add_argument("stage", choices=["all", "common-customers", "neighbours", "triples"])
    parser.add_argument("--books", help="Books review parquet (stage 1)")
    parser.add_argument("--music", help="Music review parquet (stage 1)")
    parser.add_argument("--source", help="input of stage 2 (pairs) or stage 3 (lists)")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--more-than-books", default="4")
    parser.add_argument("--more-than-music", default="5")
    parser.add_argument("--mode", default="documented", choices=["documented", "as_written"])
    parser.add_argument("--expand", action="store_true", help="stage 3 writes all triples (quadratic)")
    parser.add_argument("--list-format", default="pairs", choices=list(LIST_FORMATS))
    parser.add_argument("--staged", default="purchases", choices=list(STAGED_FORMATS))
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"revlens-training-set-{args.stage}").getOrCreate()
    if args.stage == "all":
        return build_training_set(
            spark, args.books, args.music, args.out, args.more_than_books, args.more_than_music,
            args.mode, expand=args.expand, list_format=args.list_format, staged=args.staged,
        )
    if args.stage == "common-customers":
        return stage_common_customers(
            spark, args.books, args.music, args.out, args.more_than_books, args.more_than_music,
            staged=args.staged,
        )
    if args.stage == "neighbours":
        return stage_neighbours(spark, args.source, args.out, list_format=args.list_format, staged=args.staged)
    return stage_triples(
        spark, args.source, args.out, args.mode, expand=args.expand, list_format=args.list_format
    )


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
