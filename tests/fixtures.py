"""Synthetic yearly tables in the six layouts plus totals.

All rows are invented.  Each defect the pipeline must catch is planted
once; the comment on a row says which.
"""

from __future__ import annotations

import os

FILES = {
    # L1, CRLF
    "burned_2015.csv": ("\r\n", [
        "ind,UC,Bioma,Area_queimada,Area_UC,Perc_UC,Data_ult_atual",
        "0,APA DO TESTE,CERRADO,25.0,1000,2.5,04/08/2015",
        "1,ESEC SERRA-VERDE,AMAZONIA,10.0,2000,0.5,01/09/2015",          # hyphen variant
        "2,PARNA DO LAGO AZUL*,MATA ATANTICA,5.0,500,1.0,10/10/2015",    # footnote mark, misspelt biome
        "3,REBIO MATA E CAMPO,MATA ATLANTICA E CERRADO,8.0,800,1.0,11/11/2015",  # two biomes; name keeps ' E '
        "4,PARNA DOS PICOS,CERRADO,30.0,1000,3.0,05/05/2015",
        "5,FLONA DO RIO CLARO,CERRADO E OUTRO,1.0,100,1.0,06/06/2015",   # ' E ' but not two known biomes
    ]),
    # L2, CRLF
    "burned_2018.csv": ("\r\n", [
        "ind,UC,Bioma,Area_queimada,Area_UC,Perc_UC,Data_ult_atual,Satelite",
        "0,APA DO TESTE,CERRADO,20.0,1000,2.0,,Landsat ",                 # empty date, blank after sensor
        "1,ESEC DA SERRA VERDE ,AMAZONIA,12.0,2000,0.6,02/09/2028,Modis",  # blank after name, date 10 years ahead
        "2,ESEC SERRA VERDE,AMAZONIA,3.0,2000,0.15,03/09/2018,Landsat / Sentinel",  # same unit twice
        "3,PARNA DOS PICOS,CERRADO,40.0,1000.004,3.9999840000639995,06/06/2018,Modis",   # size rewrite in last digits
        "4,PARNA LAGO AZUL,MATA ATLANTICA,2.0,500,0.4,07/07/2018,Modis",  # preposition variant
    ]),
    # L3, CRLF
    "burned_2020.csv": ("\r\n", [
        "ind,UC,Bioma,Incendio,MIF,Area_queimada,Area_UC,Perc_UC,Data_ult_atual,Satelite",
        "0,APA DO TESTE,CERRADO,,,25.0,1000,2.5,04/08/2020,Modis",               # both causes empty
        "1,ESEC SERRA VERDE,AMAZONIA,6.0,,6.0,2000,0.3,04/08/2020,Modis",         # one cause empty
        "2,PARNA DO LAGO AZUL,MATA ATLANTICA,0,0,0.0,500,0.0,04/08/2020,Modis",   # explicit zeros
        "3,PARNA DOS PICOS,CERRADO,1.0,1.0,2.0,2000,0.1,04/08/2020,Modis",        # size of another unit
        "4,REBIO CAMPOLANA DO SUL,CAATINGA,1.0,0.5,1.5,700,0.2142857142857143,04/08/2020,Modis",  # one-letter misspelling
    ]),
    # L4, LF
    "burned_2021.csv": ("\n", [
        ",UC,Bioma,Fogo_natural,Queima_indig_isol,Incendio,Queima_controlada,Queima_prescrita,"
        "Gestao_raio,Aceiro_negro,Area_queimada,Area_UC,`Perc_UC,Data_ult_atual,Satelite",
        "0,APA DO TESTE,CERRADO,0.0,0.0,20.0,0.0,5.0,0.0,0.0,25.0,1000.0,2.5,2022-01-15,Modis",
        "1,PARNA DOS PICOS,CERRADO,0.0,0.0,10.0,0.0,0.0,0.0,0.0,12.0,1000.0,1.2,2022-01-15,Modis",  # total != parts
        "2,REBIO CAMPLANA DO SUL,CAATINGA,0.0,0.0,1.0,0.0,0.0,0.0,0.0,1.0,700.0,0.14285714285714285,2022-01-15,Modis",
        "3,PARNA DO LAGO AZUL,MATA ATLANTICA,0.0,0.0,2.0,0.0,0.0,0.0,0.0,2.0,300.0,0.6666666666666666,2022-01-15,Modis",
    ]),
    # L5, CRLF: no biome, date or sensor
    "burned_2022.csv": ("\r\n", [
        "ind,UC,Incendio,Queima_prescrita,Queima_controlada,Aceiro,Fogo_natural,Queima_indigena,"
        "Raio,Area_total,Area_UC,Perc_AAF_UC",
        "0,APA DO TESTE,20,5,0,0,0,0,0,25,1000,2.5",
        "1,ESEC NOVA UNIDADE,1,0,0,0,0,0,0,1,100,1.0",                # never seen before
        "2,PARNA DOS PICOS,0.001,0,0,0,0,0,0,0.001,1000,0.0",         # positive area, percent rounds to 0
        "3,APA CAMPLANA DO SUL,1,0,0,0,0,0,0,1,300,0.33",              # same name, other category and size
    ]),
    # L6, CRLF
    "burned_2023.csv": ("\r\n", [
        "ind,UC,NGI,Incendio,Queima_prescrita,Queima_controlada,Aceiro,Fogo_natural,"
        "Indigena_isolado,Total_prevencao,Total_combate,Area_total,Area_UC,Perc_AAF_UC",
        "0,APA DO TESTE,-,20,5,0,0,0,0,5,20,25,1000,2.5",             # '-' for no group
        "1,PARNA DOS PICOS,Grupo Norte,3,1,1,0,2,0,2,5,7,4000,0.18",  # size change (new version)
    ]),
    # totals, LF; 2015 and 2020-2021 are not published, 2018 is wrong
    "totals.csv": ("\n", [
        "AREA_QUEIM_ANO,ano",
        "32.0,2023",
        "27.001,2022",
        "70.0,2018",
    ]),
}


def write_fixture(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, (eol, lines) in FILES.items():
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(eol.join(lines) + eol)
    return folder
