"""Energy-retail and home-battery fleet analytics as Spark DataFrame operators."""

from wattloom.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
