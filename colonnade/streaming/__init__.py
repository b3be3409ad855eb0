"""Streaming forms of the batch operators.

The original jobs are batch only: ``window`` is used on a static table.  The
one operator with a natural incremental form is the tumbling-window count
(W1/A15); :func:`weekly_counts_stream` runs the very same
:func:`colonnade.operators.windows.tumbling_count` on a streaming DataFrame,
with a watermark so that window state is dropped once late data can no
longer arrive.  Nothing else is added here.
"""

from colonnade.streaming.windows import weekly_counts_stream

__all__ = ["weekly_counts_stream"]
