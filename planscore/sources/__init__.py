from planscore.sources.tables import Tables

__all__ = ["Tables"]
