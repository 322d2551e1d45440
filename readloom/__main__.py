"""Command line: species counts of a run folder, by mapping or with a saved classifier, as a CSV table.

    spark-submit --py-files ... -m readloom -r RUN -o OUT -s SPECIES        (or: python -m readloom ...)
    python -m readloom -r RUN -o OUT -c -m MODEL -p 0.9
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from readloom.config import PRIMER_SETS, primer_set
from readloom.functions.sequences import reverse_complement_text
from readloom.operators import models, qc
from readloom.operators.reads import StageCounts
from readloom.plans import runs
from readloom.sources.staging import materialize, scratch


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser("readloom", description="Species counts of the barcodes of a sequencing run.")
    p.add_argument("-c", "--classify", action="store_true", help="classify reads with a saved model instead of mapping them")
    p.add_argument("-s", "--species", help="folder of FASTA files, one a species (mapping)")
    p.add_argument("-m", "--model", default="./model", help="saved classifier (with -c)")
    p.add_argument("-r", "--run", required=True, help="run folder with barcode*/*.fastq.gz")
    p.add_argument("-o", "--out", required=True, help="folder for the results")
    p.add_argument("-a", "--primers", default="cherif", choices=[x.lower() for x in PRIMER_SETS])
    p.add_argument("-t", "--parallel", type=int, help="shuffle partitions; the cluster's setting by default")
    p.add_argument("-q", "--mapq", type=int, default=40, help="least mapping quality")
    p.add_argument("-k", "--kmers", type=int, default=28, help="length of the aligner's k-mers")
    p.add_argument("-p", "--threshold", type=float, default=0.9, help="least probability of a read's class (with -c)")
    found = p.parse_args(given)
    if not found.classify and not found.species:
        p.error("mapping needs -s")
    return found


def main(given: list[str] | None = None) -> None:
    a = arguments(given)
    spark = SparkSession.builder.appName("readloom").getOrCreate()
    if a.parallel:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.parallel))
    with scratch(spark):
        raw = runs.load_run(spark, a.run)
        for name, reads in (("before", raw), ("after", runs.trimmed(raw, a.primers))):
            p = primer_set(a.primers)
            ends = {f"forward {k + 1}": x for k, x in enumerate(p.forwards)} | {f"reverse {k + 1}": reverse_complement_text(x) for k, x in enumerate(p.reverses)}
            for table, rows in qc.tables(materialize(reads, "reads"), ends).items():
                rows.coalesce(1).write.csv(f"{a.out}/quality_{name}/{table}", header=True, mode="overwrite")
        model, calibration = (models.load(a.model), models.load_calibration(a.model)) if a.classify else (None, None)
        seen = StageCounts()
        runs.run(spark, a.run, f"{a.out}/counts", None if a.classify else a.species, model, a.primers, a.kmers, a.mapq, a.threshold, seen, calibration)
        seen.table(spark).coalesce(1).write.csv(f"{a.out}/stages", header=True, mode="overwrite")


if __name__ == "__main__":
    main()
