"""Report headings.  Internal column names stay ASCII; headings are applied
as the very last step (they hold accents, spaces, ``%`` and parentheses)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The headings each report is written with.
HEADINGS = {
    "web": {
        "month": "Mês",
        "year": "Ano",
        "sessions": "Sessões totais (todos os canais)",
        "revenue": "Receita total (todos os canais)",
    },
    "app": {
        "month": "Mês",
        "year": "Ano",
        "active_users": "Usuários ativos",
        "sessions": "Sessões",
        "revenue": "Receita",
    },
    "organic": {
        "month": "Mês",
        "year": "Ano",
        "sessions": "Sessões orgânicas",
        "active_users": "Usuários orgânicos",
        "engagement_pct": "Taxa de engajamento (%)",
        "revenue": "Receita orgânica",
    },
    "app_year": {
        "month": "Mês",
        "year": "Ano",
        "app_users_total": "App_Usuários_total",
        "app_sessions_total": "App_Sessões_total",
        "app_revenue_total": "App_Receita_total",
    },
}


def headings(report: str) -> dict[str, str]:
    return dict(HEADINGS[report])


def labelled(df: DataFrame, report: str) -> DataFrame:
    """Rename a report's columns to its headings (only those present)."""
    h = {k: v for k, v in HEADINGS[report].items() if k in df.columns}
    return df.withColumnsRenamed(h)
