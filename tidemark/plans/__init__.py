from tidemark.plans.build import MARTS, WarehouseBuild

__all__ = ["MARTS", "WarehouseBuild"]
