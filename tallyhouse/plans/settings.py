"""Session settings for a given amount of input."""

from __future__ import annotations

PARTITION_BYTES = 256 * 1024**2  # one shuffle partition: fits an executor core's share of memory


def settings_for(input_bytes: int, cores: int, most_partitions: int | None = None) -> dict[str, str]:
    """Settings for jobs that may shuffle ``input_bytes`` on ``cores`` executor cores.

    The number of shuffle partitions is an upper end: small ones are joined and skewed
    ones split while a job runs.  It is also the number of pieces a hot join key is
    split into.  ``most_partitions`` limits it for a driver that cannot keep track of so
    many; partitions then grow over the size above.
    """
    wanted = -(-input_bytes // PARTITION_BYTES)
    partitions = max(wanted, 2 * cores, 1)
    if most_partitions is not None:
        partitions = min(partitions, most_partitions)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES // 2),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
    }
