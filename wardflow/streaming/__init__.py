from wardflow.streaming.incremental import stream_load  # noqa: F401
