"""Tables written to the folder that driver and executors share (``sources.scratch``)."""

from metafleet.sources.scratch import dropped, new_path, outcome, passing, shared_dir, written

__all__ = ["dropped", "new_path", "outcome", "passing", "shared_dir", "written"]
