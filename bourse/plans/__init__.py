from bourse.plans.sizing import bounded_broadcast

__all__ = ["bounded_broadcast"]
