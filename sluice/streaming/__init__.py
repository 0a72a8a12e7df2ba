"""Activity-stream plans.

Every plan takes a batch frame or a stream: on a batch frame the watermark has
no effect and the result is that of a stream that has seen all its input.
"""
