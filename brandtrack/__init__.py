"""Brand-conversion sales tracking as Spark DataFrame jobs."""

from .params import ReportParams
from .report import BrandReport
from .sources.tables import Tables, site_list, tables_from

__all__ = ["BrandReport", "ReportParams", "Tables", "site_list", "tables_from"]
