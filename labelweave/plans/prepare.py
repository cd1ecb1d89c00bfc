"""A folder tree of structured addresses to a labelled corpus: one scan, one
projection, one write, and no shuffle."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.config import PRESETS
from labelweave.operators import labelling as lab
from labelweave.operators import records as rec
from labelweave.operators.sampling import with_split
from labelweave.sources import address_files as af
from labelweave.sources import sinks


def label_tree(spark, root, augmentation=PRESETS["full"], strip_periods="fields",
               tag_mode="position", text_mode="tokens"):
    """Columns text, label and split."""
    rows = af.with_parts(af.read_tree(spark, root), root)
    # A row's own content is its key, so draws repeat after a retry.
    content = [F.coalesce(F.col(name), F.lit("")) for name in fixed.FILE_LABELS]
    key = F.md5(F.concat_ws("|", "path", *content))
    keyed = rec.clean_columns(rows, strip_periods=strip_periods).withColumn("key", key)
    records = rec.with_fields(rec.with_path_fields(keyed, F.col("parts")))
    ordered = lab.with_order(records, "key", augmentation)
    labelled = lab.annotate(lab.label_records(ordered, tag_mode=tag_mode, text_mode=text_mode))
    return with_split(labelled, "key", seed=augmentation.seed).select(
        "key", "text", "label", "split")


def prepare_corpus(spark, root, out, **settings):
    """The whole preparation, written as parquet by split."""
    sinks.write_corpus(label_tree(spark, root, **settings), out)
