"""The driver contract and the column order of the reports."""

import pytest

import __spark_entry__ as contract
from carelens.checks.oracle import all_oracles
from carelens.checks.queries import REPORT_PARAMS, SITE, all_queries
from carelens.plans.reports import REPORTS
from carelens.sources.star import clinical_from_star
from conftest import SMALL

ADDRESS = "Distrito PAdministrativo Localidade Bairro PontoReferencia"
BOOKED = "data_fila data_proximo_lev data_seguimento data_proximo_seguimento patient_id"
COLUMNS = {
    "vl_eligible_general": f"nid nome gender idade {ADDRESS} contacto pessoa data_inicio ultimo_regime"
    f" data_carga valor_carga referencia {BOOKED}",
    "vl_eligible_pregnant": f"nid nome gender idade {ADDRESS} contacto pessoa referencia data_inicio"
    f" ultimo_regime data_carga valor_carga {BOOKED}",
    "vl_failure": f"nid nome gender idade data_inicio {ADDRESS} contacto pessoa referencia ultimo_regime"
    f" data_carga valor_carga {BOOKED}",
    "vl_suppressed": "patient_id NID NomeCompleto gender idade_actual crianca data_inicio cv data_cv gravida"
    f" proxima_consulta proximo_lev {ADDRESS} contacto pessoa",
    "entered_master_card": "patient_id NID NomeCompleto sexo dead death_date idade_abertura idade referencia"
    " inscricao_cuidado data_inicio data_ultimo_segmento data_proximo_segmento utilizador",
    "entered_full": "patient_id NID NomeCompleto sexo dead death_date idade_abertura idade parteA parteB"
    " referencia data_inscricao_pretarv pretarv_livro pretarv_pagina pretarv_linha inscricao_cuidado"
    " estado_pre_tarv data_inicio data_inscricao_tarv tarv_livro tarv_pagina tarv_linha"
    " inscricao_tratamento estado_tarv data_ultimo_segmento data_proximo_segmento data_ultimo"
    " data_proximo CD4 estadio programa_tb programa_ptv utilizador",
    "dsd_followup": "patient_id NID NomeCompleto idade_actual sexo data_diagnostico data_inicio_tarv"
    " ultimo_regime data_primeira_cv_suprimida primeira_cv_suprimida data_inclusao_mdc tipo_modelo"
    " carga_viral_MDS primeiro_levantamento_MDS segundo_levantamento_MDS ultimo_levantamento_MDS"
    " primeira_fichaapss segunda_fichaapss ultima_fichaapss",
    "three_pickups": "patient_id NID NomeCompleto idade_actual gender data_inicio gravida data_ultimo"
    " proximo_consulta ultimo_levantamento data_proximo data_saida estado levantou",
    "tpt_eligible": "name patient_id NID NomeCompleto gender idade_actual data_inicio_inh data_fim_inh"
    " data_inicio_tarv dias_inh meses_inh",
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_column_order(spark, name):
    df = REPORTS[name](clinical_from_star(spark, SMALL), REPORT_PARAMS.get(name, SITE))
    assert df.columns == COLUMNS[name].split()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_names_agree():
    assert set(all_queries()) == set(all_oracles())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(COLUMNS) <= set(contract.queries())
