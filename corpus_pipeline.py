"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage works on what its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from labelweave.llm import mixing, order_minhash, packing, quality, toxicity
from labelweave.llm.common import folded, table
from labelweave.session import materialise, ship_package


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and keep enough beside frequent lines,
    without those lines."""
    return quality.kept_documents(docs)


def drop_toxic(spark, docs, sf_dir):
    """Documents not predicted toxic. The models are learned from the labelled
    documents of the input, whether or not an earlier stage kept them."""
    ship_package(spark)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    plain, unfold = folded(docs, ["doc_id", "text"])
    return unfold(toxicity.score(plain, model).where("predicted = 0"))


def drop_near_copies(spark, docs, sf_dir):
    """One document of every class of near copies, the one of the smallest number."""
    ship_package(spark)
    return order_minhash.one_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A document that the mix repeats is packed as often."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Neither the models nor the alignments can be written in SQL; the tests hold the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
