"""What a particular data set looks like: column mapping, entities and table names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


# Field names of the two JSON documents; what is missing here keeps its own name.
NEUTRAL_FIELDS = {
    name: name
    for name in (
        "missing_in missing_out surplus undated negative coverage first last rows_in rows_out "
        "volatility rises falls"
    ).split()
}

# The same for the commodity price file.
COMMODITY_FIELDS = {
    "missing_in": "completude_nulos_antes_tratamento",
    "missing_out": "completude_nulos_apos_tratamento",
    "surplus": "unicidade_duplicatas_de_data_removidas",
    "undated": "consistencia_linhas_sem_data_valida_removidas",
    "negative": "acuracia_valores_negativos_encontrados",
    "coverage": "periodo_coberto",
    "first": "inicio",
    "last": "fim",
    "rows_in": "total_linhas_bronze",
    "rows_out": "total_linhas_silver",
    "correlation:Cobre~Minério de Ferro": "correlacao_cobre_minerio_ferro",
    "volatility": "volatilidade_geral_desvio_padrao_pct",
    "rises": "maiores_altas_mensais",
    "falls": "maiores_quedas_mensais",
    "benchmark:Cobre": "correlacao_cobre_indice_metais",
    "benchmark:Minério de Ferro": "correlacao_minerio_indice_metais",
    "growth:Cobre": "crescimento_pct_periodo_cobre",
    "growth:Minério de Ferro": "crescimento_pct_periodo_minerio_ferro",
}


@dataclass(frozen=True)
class Layout:
    """Names of one wide source and of the star schema made from it."""

    mapping: Mapping[str, str]
    date: str
    benchmark: str
    entities: tuple[Mapping[str, object], ...]
    tables: Mapping[str, str]
    entity: str = "entity_id"
    name: str = "entity_name"
    origin: str = "source_column"
    value: str = "value"
    change: str = "change_pct"
    year: str = "year"
    month: str = "month"
    stats: tuple[str, str, str, str] = ("mean_value", "min_value", "max_value", "sd_value")
    focus: tuple[str, ...] = ()
    labels: Mapping[str, str] = field(default_factory=lambda: dict(NEUTRAL_FIELDS))

    @property
    def measures(self) -> list[str]:
        """Numeric Silver columns, benchmark included."""
        return [column for column in self.mapping.values() if column != self.date]

    @property
    def entity_columns(self) -> dict[str, int]:
        """Silver column -> entity key."""
        return {row[self.origin]: row[self.entity] for row in self.entities}

    @property
    def grain(self) -> dict[str, str]:
        """Keyword arguments that tell panel operators the column names."""
        return {"date": self.date, "entity": self.entity, "value": self.value}


# The names of the monthly commodity price file and of its tables. Queries
# already written against these tables run unchanged, once ``run`` is given the texts of
# the dimension's descriptive column.
COMMODITIES = Layout(
    mapping={
        "Date": "data_referencia",
        "Metals Price Index": "indice_precos_metais",
        "Copper": "preco_cobre_usd_ton",
        "China import Iron Ore Fines 62% FE spot": "preco_minerio_ferro_usd_ton",
        "Aluminum": "preco_aluminio_usd_ton",
        "Nickel": "preco_niquel_usd_ton",
        "Zinc": "preco_zinco_usd_ton",
    },
    date="data_referencia",
    benchmark="indice_precos_metais",
    entities=(
        {
            "commodity_id": 1,
            "commodity_nome": "Cobre",
            "coluna_origem": "preco_cobre_usd_ton",
            "unidade": "USD/tonelada",
        },
        {
            "commodity_id": 2,
            "commodity_nome": "Minério de Ferro",
            "coluna_origem": "preco_minerio_ferro_usd_ton",
            "unidade": "USD/tonelada",
        },
        {
            "commodity_id": 3,
            "commodity_nome": "Alumínio",
            "coluna_origem": "preco_aluminio_usd_ton",
            "unidade": "USD/tonelada",
        },
        {
            "commodity_id": 4,
            "commodity_nome": "Níquel",
            "coluna_origem": "preco_niquel_usd_ton",
            "unidade": "USD/tonelada",
        },
        {
            "commodity_id": 5,
            "commodity_nome": "Zinco",
            "coluna_origem": "preco_zinco_usd_ton",
            "unidade": "USD/tonelada",
        },
    ),
    tables={
        "bronze": "bronze_commodity_prices_raw",
        "silver": "silver_commodity_prices",
        "dimension": "gold_dim_commodity",
        "monthly": "gold_fato_precos_mensais",
        "annual": "gold_fato_precos_anuais",
        "change": "gold_fato_variacao_mensal",
    },
    entity="commodity_id",
    name="commodity_nome",
    origin="coluna_origem",
    value="preco_usd_ton",
    change="variacao_pct_mom",
    year="ano",
    month="mes",
    stats=("preco_medio", "preco_minimo", "preco_maximo", "desvio_padrao"),
    focus=("Cobre", "Minério de Ferro"),
    labels=COMMODITY_FIELDS,
)
