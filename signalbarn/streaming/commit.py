"""Publishing a micro-batch into day folders exactly once.

A micro-batch is staged first: sorted, day-partitioned Parquet in a hidden folder
beside the tables. Then a plan is written down, one line per file: where it lies
and where it belongs. Only then files move. A batch that is replayed finds

- no plan: staging did not end, so it is done again from the start;
- a plan: the files not moved yet are moved, those moved stay;
- its number in the ledger: nothing is left to do.

So a replay neither doubles nor loses rows, and no folder is named after a batch.
The ledger keeps one number per stream, since Spark replays only the last batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from signalbarn.functions.files import Store
from signalbarn.sources.tables import add_days, day_folders, day_of_folder


@dataclass(frozen=True)
class Part:
    """Staged files of one batch and the table (or, without one, the plain folder) they belong to."""

    staged: str
    path: str
    table: str | None = None
    full_name: str | None = None


def _planned(spark: SparkSession, store: Store, part: Part, name: str) -> list[dict]:
    """A move for each staged file, with the day it belongs to."""
    moves = []
    files = [f for f, _ in store.files(part.staged)]
    days = {f: day_of_folder(f, part.table) if part.table else None for f in files}
    wanted = sorted({d for d in days.values() if d})
    folders = day_folders(spark, part.table, part.path, part.full_name, wanted) if part.table else {}
    for n, file in enumerate(files):
        folder = folders[days[file]] if part.table else part.path
        moves.append(
            {
                "from": file,
                "to": f"{folder}/{name}-{n:05d}.zstd.parquet",
                "day": days[file],
                "folder": folder,
                "table": part.table,
                "full_name": part.full_name,
            }
        )
    return moves


def _publish(spark: SparkSession, store: Store, moves: list[dict]) -> None:
    for move in moves:
        store.move(move["from"], move["to"])
    for name in sorted({m["full_name"] for m in moves if m["full_name"]}):
        own = [m for m in moves if m["full_name"] == name]
        add_days(spark, own[0]["table"], name, {m["day"]: m["folder"] for m in own})


def commit_batch(
    spark: SparkSession, ledger: str, stream: str, batch_id: int, prepare: Callable[[str], list[Part]]
) -> bool:
    """Stage, plan and publish one micro-batch; False if it was published before.

    `prepare` writes the batch below the folder it is given and says which parts
    it made. The ledger lies in the same store as the tables, so that files move
    without being copied.
    """
    store = Store(spark, ledger)
    last = store.note(f"{ledger}/{stream}.json") or {"last": -1}
    if batch_id <= last["last"]:
        return False
    name = f"{stream}-{batch_id:012d}"
    plan, folder = f"{ledger}/{name}.plan", f"{ledger}/{name}"
    if not store.exists(plan):
        store.delete(folder)
        parts = prepare(folder)
        moves = [m for p in parts for m in _planned(spark, store, p, f"{name}-{p.table or 'rejects'}")]
        store.write_note(plan, {"moves": moves})
    _publish(spark, store, store.note(plan)["moves"])
    store.write_note(f"{ledger}/{stream}.json", {"last": batch_id})
    store.delete(folder)
    store.delete(plan)
    return True
