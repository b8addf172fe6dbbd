"""floe: stream and batch analytics operators on PySpark.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a
``Column``); nothing runs until an action.  The main entry points:

* text: ``tokenize``, ``word_count``, ``uri_count``
* windows: ``windowed`` (tumbling / sliding, direct or pane pre-aggregation)
* window-over-window: ``track_change``, ``large_delta``, ``window_price_stats``,
  ``item_window_counts``, ``top_items``, ``top_n``
* sequences: ``with_previous_row``, ``price_jumps``
* records: ``parse_delimited``, ``explode_envelope``, ``first_of_envelope``,
  ``pack_envelopes``, ``fill_defaults``, ``fill_template``
* aggregates / models: ``keyed_profit``, ``indicator_ratio``, ``descend``, ``gd_step``
* streams: ``with_event_time``, ``guarded_filter``, ``stream_window_change``,
  ``stream_price_jumps``, ``stream_top_items``, ``run_available``
"""

from floe.functions.json import explode_envelope, first_of_envelope
from floe.functions.parse import parse_delimited
from floe.functions.text import tokenize
from floe.functions.urls import fill_template
from floe.operators.change import large_delta, track_change, window_price_stats
from floe.operators.counts import uri_count, word_count
from floe.operators.envelopes import pack_envelopes
from floe.operators.profit import keyed_profit
from floe.operators.ratio import indicator_ratio
from floe.operators.regression import descend, gd_step
from floe.operators.sequence import with_previous_row
from floe.operators.signals import price_jumps
from floe.operators.topn import item_window_counts, top_items, top_n
from floe.operators.windows import windowed
from floe.schemas import fill_defaults
from floe.streaming.event_time import guarded_filter, with_event_time
from floe.streaming.operators import stream_price_jumps, stream_top_items, stream_window_change
from floe.streaming.runner import run_available

__all__ = [
    "descend",
    "explode_envelope",
    "fill_defaults",
    "fill_template",
    "first_of_envelope",
    "gd_step",
    "guarded_filter",
    "indicator_ratio",
    "item_window_counts",
    "keyed_profit",
    "large_delta",
    "pack_envelopes",
    "parse_delimited",
    "price_jumps",
    "run_available",
    "stream_price_jumps",
    "stream_top_items",
    "stream_window_change",
    "tokenize",
    "top_items",
    "top_n",
    "track_change",
    "uri_count",
    "window_price_stats",
    "windowed",
    "with_event_time",
    "with_previous_row",
    "word_count",
]
