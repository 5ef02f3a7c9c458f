"""Customer-loyalty analytics for Spark: views, indices and personal offers."""

from tallystick.plans.model import LoyaltyModel
from tallystick.session import build_session, tune
from tallystick.sources.tables import Tables

__all__ = ["LoyaltyModel", "Tables", "build_session", "tune"]
