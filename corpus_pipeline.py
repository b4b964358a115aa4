"""The training-data pipeline: documents -> a clean, weighted mixture.

``STAGES`` lists (name, function); each function takes (spark, docs,
sf_dir), works on everything its predecessor kept, and returns a DataFrame
that is written as Parquet and read again for the next stage.
"""

from __future__ import annotations

from strata.llm import decontaminate, mixing, near_dup, privacy, toxicity
from strata.session import scratch_path
from strata.sources.tables import table


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the classifier, trained on the labelled ones, rejects go."""
    return toxicity.remove_toxic(docs, docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark, docs, sf_dir):
    """One document, the smallest doc_id, of each near-duplicate group stays."""
    return near_dup.drop_near_duplicates(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Documents of which a twentieth of the words are benchmark passages go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def privacy_stage(spark, docs, sf_dir):
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    return privacy.redact(docs)


def mixing_stage(spark, docs, sf_dir):
    """The mixture of sources, with the pass and the tokens of each row."""
    return mixing.mix(docs)


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("privacy", privacy_stage), ("mixing", mixing_stage)]

# classifiers decide in the first and fourth stage, which SQL cannot express
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written in the shared
    checkpoint folder and read again, so a stage never repeats another."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"pipeline-{i}-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
