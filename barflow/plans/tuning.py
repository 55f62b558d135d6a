"""Session settings sized from the data volume (for a real cluster).

Library operators never change session settings; a job launcher passes these
to ``SparkSession.builder.config`` (or ``spark-submit --conf``). Rules:

* input splits of ``split_mb`` (default 256 MB) so a scan task stays well
  inside executor memory;
* initial shuffle partitions = shuffle bytes / ``partition_mb`` (512 MB),
  rounded up to a multiple of the total core count, at least the cores;
  AQE then coalesces small partitions and splits skewed join partitions;
* broadcast joins only for small sides (the operators also size-check).
"""

from __future__ import annotations

import math


def recommended_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 1.0,
                     split_mb: int = 256, partition_mb: int = 512) -> dict[str, str]:
    shuffle_bytes = max(1, int(input_bytes * shuffle_ratio))
    parts = max(total_cores, math.ceil(shuffle_bytes / (partition_mb << 20)))
    parts = int(math.ceil(parts / total_cores) * total_cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{min(partition_mb, 256)}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
