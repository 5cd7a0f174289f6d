"""Spark jobs over file manifests and sectioned HTML documents."""

from sheafwork.session import build_session, drop_folder, shared_folder, shuffle_partitions

__all__ = ["build_session", "drop_folder", "shared_folder", "shuffle_partitions"]
