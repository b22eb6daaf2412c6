"""Streaming.

Intentionally empty: the reference jobs are all batch (no stream source, sink,
watermark, window or stateful operator), so there is nothing to re-express with
Structured Streaming. Every operator in ``shiftwise.operators`` is a plain
DataFrame function, so it can be applied per micro-batch inside a
``foreachBatch`` sink if a streaming feed is ever added.
"""
