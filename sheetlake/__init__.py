"""sheetlake: folders of exported business reports as Spark tables.

Scan drifting report files in parallel, land them as text, clean and
promote their columns, keep an append-only ledger of every source file,
and compute the revenue / customer reports on top — all as DataFrame
plans that Catalyst and AQE optimise.
"""

from sheetlake.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
