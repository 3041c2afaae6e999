"""Interface layer: French-labelled dashboard views over the marts.

A dashboard is the mart exported as unpartitioned Parquet (mart column
names) and a named view with display labels.  Failures raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# View names and (mart column -> display label) pairs.
FINANCE_VIEW = "finance_dashboard_view"
FINANCE_LABELS = (
    ("dt", "date"),
    ("customer_nation", "pays_client"),
    ("customer_region", "region_client"),
    ("total_revenue", "revenu_total"),
    ("total_tax", "taxes_totales"),
    ("total_discounts", "remises_totales"),
    ("accounts_receivable", "creances_clients"),
    ("estimated_margin", "marge_estimee"),
    ("margin_percentage", "taux_marge_pct"),
    ("order_count", "nombre_commandes"),
    ("average_order_value", "valeur_moyenne_commande"),
    ("avg_open_order_age", "age_moyen_commandes_jours"),
)
MARKETING_VIEW = "marketing_dashboard_view"
MARKETING_LABELS = (
    ("month", "mois"),
    ("market_segment", "segment_marche"),
    ("total_revenue", "revenu_total"),
    ("avg_order_value", "valeur_moyenne_commande"),
    ("order_count", "nombre_commandes"),
    ("late_delivery_rate", "taux_retard_livraison_pct"),
    ("top_brand", "marque_preferee"),
)


def labelled(mart: DataFrame, labels: tuple[tuple[str, str], ...]) -> DataFrame:
    return mart.select(*[F.col(src).alias(dst) for src, dst in labels])


def finance_dashboard(finance_mart: DataFrame) -> DataFrame:
    return labelled(finance_mart, FINANCE_LABELS)


def marketing_dashboard(marketing_mart: DataFrame) -> DataFrame:
    return labelled(marketing_mart, MARKETING_LABELS)


def export(mart: DataFrame, path: str) -> None:
    """Write the mart, run stamp included, as one unpartitioned Parquet dataset."""
    mart.write.mode("overwrite").parquet(path)


def publish(mart: DataFrame, labels: tuple[tuple[str, str], ...], view_name: str,
            export_path: str | None = None) -> DataFrame:
    """Export the mart (if a path is given) and register the labelled view."""
    if export_path:
        export(mart, export_path)
    view = labelled(mart, labels)
    view.createOrReplaceTempView(view_name)
    return view
