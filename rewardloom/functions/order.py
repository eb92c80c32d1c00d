"""The one total order every operator uses instead of physical row order.

Source order is ``datetime DESC NULLS FIRST, chat_id ASC, msg_pos ASC``.
``seq`` encodes it as a single sortable struct: ascending ``seq`` is source
order, ``min(seq)`` is first seen and ``max_by(x, seq)`` is the last write.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_col(ts) -> Column:
    return F.unix_seconds(_c(ts))


def seq_col(epoch, id_col, pos_col) -> Column:
    e = _c(epoch)
    return F.struct(e.isNotNull().alias("dated"), (-e).alias("neg_epoch"),
                    _c(id_col).alias("id"), _c(pos_col).alias("pos"))
