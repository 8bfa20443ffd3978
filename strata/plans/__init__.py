from .runner import Medallion
from .specs import HopSpec, load_registry, plan_objects

__all__ = ["HopSpec", "Medallion", "load_registry", "plan_objects"]
