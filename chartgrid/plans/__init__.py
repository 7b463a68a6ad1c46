from .assemble import IcuPipeline

__all__ = ["IcuPipeline"]
