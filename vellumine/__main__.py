"""Command line: ``extract TEXTS OUT`` and ``ocr SCANS OUT``, with settings as flags.

extract takes --profile FILE, --backend NAME, --limit N, --force and every setting of a
profile; ocr takes --engine NAME, --limit N, --force and the engine's settings as KEY=VALUE.
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import partial

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from vellumine.session import LOCAL_CONF, ship

    builder = SparkSession.builder.appName("vellumine")
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def main(arguments: list[str]) -> int:
    from vellumine import config
    from vellumine.operators import engines, images, pages, runs

    parser = argparse.ArgumentParser(prog="vellumine", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("what", choices=("extract", "ocr"))
    parser.add_argument("source")
    parser.add_argument("out")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--profile")
    parser.add_argument("--backend", default="echo")
    parser.add_argument("--engine", default="tesseract")
    known, rest = parser.parse_known_args(arguments)
    if known.what == "extract":
        base = config.load_profile(known.profile) if known.profile else config.Profile()
        told = runs.extract_texts(_session(), known.source, known.out, config.overridden(base, **config.flags(rest)), known.backend, limit=known.limit, force=known.force)
    else:
        settings = dict(x.split("=", 1) for x in rest)
        engine = partial(pages.plug_in(known.engine, engines.RECOGNISERS), **settings)
        told = runs.read_scans(_session(), known.source, known.out, images.PlainDecoder, images.BlockSegmenter, engine, limit=known.limit, force=known.force, engine=known.engine, settings=settings)
    print(json.dumps(told, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
