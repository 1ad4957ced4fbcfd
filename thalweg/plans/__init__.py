from thalweg.plans.snapping import Sources, build

__all__ = ["Sources", "build"]
