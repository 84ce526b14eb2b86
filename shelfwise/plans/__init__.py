"""Report pipelines (K1-K8): functions from DataFrames to DataFrames.

Modules: ``popular_match`` (K1 do_sell, K2 not_sold, K3 popular),
``decline_report`` (K4), ``margin_report`` (K5), ``size_report`` (K6) and
``views`` (K7, K8), ``weekly`` (the weekly job writing all tables) and
``run_ledger`` (all tables of a week as one run with a ledger).
"""

from .decline_report import decline
from .margin_report import margins
from .popular_match import do_sell, not_sold, popular_top
from .run_ledger import publish, publish_weekly, read_published, register_published_views
from .size_report import sizes
from .views import do_sell_by_month, do_sell_by_week
from .weekly import WeeklyInputs, register_views, run_weekly, weekly_reports

__all__ = ["do_sell", "not_sold", "popular_top", "decline", "margins", "sizes",
           "do_sell_by_month", "do_sell_by_week", "WeeklyInputs", "weekly_reports", "run_weekly", "register_views",
           "publish", "publish_weekly", "read_published", "register_published_views"]
