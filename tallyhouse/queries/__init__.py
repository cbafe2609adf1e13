"""Every operator as a query over the star tables, with equivalent SQL to check it."""

from . import (campaigns, cleaning, contacts, customers, extraction, incremental, joining, logs,
               products, shaping, staff)
from .registry import ORACLE, QUERIES

MODULES = (incremental, extraction, cleaning, joining, shaping, customers, campaigns, contacts,
           staff, products, logs)

__all__ = ["ORACLE", "QUERIES", "MODULES"]
