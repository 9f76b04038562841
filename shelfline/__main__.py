"""Run layers from the command line: ``python -m shelfline <step> --root <path> ...``."""

from __future__ import annotations

import argparse

from shelfline.names import INVENTORY_TABLE, MARKETPLACE_TABLE, STOREFRONT_TABLE
from shelfline.operators.batches import Batch
from shelfline.plans import bronze, catalog, quality, runs
from shelfline.sources.session import build_session
from shelfline.streaming.file_drop import load_new_files


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfline")
    parser.add_argument("step", choices=["bronze", "drop", "silver", "gold", "quality", "run", "catalog"])
    parser.add_argument("--root", required=True, help="folder or bucket path of the layer tables")
    parser.add_argument("--storefront", help="CSV path of the storefront order feed")
    parser.add_argument("--marketplace", help="CSV path of the marketplace order feed")
    parser.add_argument("--inventory", help="CSV path of the inventory feed")
    parser.add_argument("--checkpoint", help="folder in which the drop step remembers what it has read")
    parser.add_argument("--batch-id", help="batch id; a new one by default")
    parser.add_argument("--reload", default="append", choices=bronze.RELOADS)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session(f"shelfline-{options.step}")
    batch = Batch(options.batch_id) if options.batch_id else Batch()
    given = {
        STOREFRONT_TABLE: options.storefront,
        MARKETPLACE_TABLE: options.marketplace,
        INVENTORY_TABLE: options.inventory,
    }
    feeds = {table: path for table, path in given.items() if path}
    root = options.root
    if options.step == "bronze":
        result = bronze.ingest(spark, root, feeds, batch, reload=options.reload)
        print(result.rows, result.unreadable, result.skipped, result.warnings)
    elif options.step == "drop":
        for table, folder in feeds.items():
            for result in load_new_files(spark, folder, table, root, f"{options.checkpoint or root + '/_drop'}/{table}", batch):
                print(result.rows, result.unreadable, result.skipped, result.warnings)
    elif options.step == "silver":
        print(runs.build_version(spark, root, batch, gates=False, whole=True).rows["silver"])
    elif options.step == "gold":
        print(runs.build_version(spark, root, batch, gates=False, whole=True).rows["gold"])
    elif options.step == "quality":
        for layer in ("bronze", "silver"):
            quality.layer_gate(runs.layer_tables(spark, root, layer), layer).show(truncate=False)
        quality.gold_gate(runs.layer_tables(spark, root, "gold")).show(truncate=False)
    elif options.step == "catalog":
        catalog.register(spark, root)
        catalog.summary(spark).show(truncate=False)
    else:
        result = runs.run_layers(spark, root, feeds, batch, reload=options.reload, run_id=batch.batch_id)
        for row in result.counts():
            print(*row)


if __name__ == "__main__":
    main()
