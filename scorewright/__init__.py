"""scorewright: configuration-driven event scoring on Spark.

JSON messages (batch or stream) -> typed columns -> derived columns ->
model prediction -> sinks, plus the offline jobs around it (encoding,
class counts, stratified split, rebalancing, training, evaluation report,
telemetry summaries).  Every operator is a DataFrame -> DataFrame function.
"""

from .functions.casts import lenient_cast
from .functions.messages import encode_messages
from .operators.classes import (
    class_counts,
    filter_class,
    hash_split,
    rebalance,
    split_features_label,
    stratified_split,
)
from .operators.parse import derive, parse_messages, parse_struct, prune
from .operators.quantiles import exact_percentiles
from .operators.report import classification_report
from .operators.score import assemble, feature_array, register_loader, score, score_mllib
from .operators.timeline import operation_means, timeline_means
from .operators.train import load_model, save_model, train_random_forest
from .sources.files import read_csv_table, read_documents, read_messages, stream_messages, stream_table
from .sources.kafka import read_kafka, read_kafka_batch
from .streaming.progress import ProgressLog, progress_frame, summarize
from .streaming.sinks import foreach_batch_writer, run_until_done, write_batch, write_stream

__all__ = [
    "ProgressLog",
    "assemble",
    "class_counts",
    "classification_report",
    "derive",
    "encode_messages",
    "exact_percentiles",
    "feature_array",
    "filter_class",
    "foreach_batch_writer",
    "hash_split",
    "lenient_cast",
    "load_model",
    "operation_means",
    "parse_messages",
    "parse_struct",
    "progress_frame",
    "prune",
    "read_csv_table",
    "read_documents",
    "read_kafka",
    "read_kafka_batch",
    "read_messages",
    "rebalance",
    "register_loader",
    "run_until_done",
    "save_model",
    "score",
    "score_mllib",
    "split_features_label",
    "stratified_split",
    "stream_messages",
    "stream_table",
    "summarize",
    "timeline_means",
    "train_random_forest",
    "write_batch",
    "write_stream",
]
