"""Incremental work. The jobs take what is not done yet in batches; nothing here is a live stream."""
