"""Times the headline queries and prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelweave.session import build_session
from labelweave.workload import catalogue

HEADLINE = [
    "n5_row_over_path", "n13_record_to_label_value",
    "a3_shuffle_order", "a4_duplicate_labels", "a5_delete_labels", "a9_full_preset_labels",
    "t3_bio_tags", "t5_annotation_offsets", "t5_long_document_offsets", "t6_annotation_cast",
    "t13_most_frequent_tag", "t15_sentence_split", "t16_sentence_tokens", "t21_tag_dictionary",
    "s2_records_from_tree", "s3_header_driven_read", "s3_layouts_in_one_scan", "s7_conll_read",
    "k1_corpus_parquet", "k3_conll_header_before", "st1_stream_ingest", "flow_a_prepare",
    "p3_bernoulli_sample", "p4_shuffle_and_mask", "p6_row_index",
    "c5_letters_only", "c8_vocabulary", "c9_idf", "c11_label_index", "c12_text_classifier",
    "g2_context_features", "g3_tagger_scores", "g4_tag_order", "g5_best_path", "g9_batches",
    "g10_pad_characters", "e1_token_accuracy", "e2_classification_report", "e3_micro_scores",
    "w1_bio_chunks", "w3_wide_record",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="labelweave-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalogue.queries()
    registered["t3_bio_tags"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
