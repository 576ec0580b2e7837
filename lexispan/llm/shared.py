"""Intermediate tables on the folder that driver and executors share."""

from __future__ import annotations

from lexispan.sources.scratch import forget, new_path, shared_folder, stored

__all__ = ["forget", "new_path", "shared_folder", "stored"]
