"""Hand-made landing files (FIXTURES.md section 5)."""

import json
import os


def listing(code, neighborhood="Gràcia", price=100000, **extra):
    rec = {
        "propertyCode": code, "thumbnail": "t", "externalReference": "e", "numPhotos": 3, "floor": "2",
        "price": price, "propertyType": "flat", "operation": "sale", "size": 70.0, "exterior": True,
        "rooms": 2, "bathrooms": 1, "address": "a", "province": "Barcelona", "municipality": "Barcelona",
        "district": "Gràcia", "country": "es", "latitude": 41.39, "longitude": 2.15, "showAddress": False,
        "url": "u", "distance": 100, "hasVideo": False, "status": "good", "newDevelopment": False,
        "hasLift": True, "priceByArea": 1500.0, "detailedType": {"typology": "flat", "subTypology": "x"},
        "suggestedTexts": {"subtitle": "s", "title": "t"}, "hasPlan": False, "has3DTour": False,
        "has360": False, "hasStaging": False, "topNewDevelopment": False,
    }
    if neighborhood is not None:
        rec["neighborhood"] = neighborhood
    rec.update(extra)
    return rec


def write_json(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(records, f, ensure_ascii=False)


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


RENT_LABEL = "Lloguer mitjà mensual (Euros/mes)"
AREA_LABEL = "Lloguer mitjà per superfície (Euros/m2 mes)"

LOOKUP_CSV = (
    "district,neighborhood,district_n_reconciled,district_n,district_id,neighborhood_n_reconciled,neighborhood_n,neighborhood_id\n"
    "Gràcia,Gràcia,Gràcia,gracia,D06,la Vila de Gràcia,la vila de gracia,N31\n"
    "Horta-Guinardó,\"Horta, Barcelona\",Horta-Guinardó,horta-guinardo,D07,\"Horta, Barcelona\",horta,N43\n"
    "Sants-Montjuïc,l'Antiga Esquerra,Sants-Montjuïc,sants,D03,l'Antiga Esquerra,antiga,N08\n"
)


def build_landing(root):
    """A landing folder with drifted listing files, rent, income and lookup CSVs."""
    ide = f"{root}/idealista"
    # snapshot 1: two listings; listing 1 later updated
    write_json(f"{ide}/2020_01_01_idealista.json", [listing(1, price=100000), listing(2, "Horta, Barcelona", 200000)])
    # snapshot 2 with parking; listing 1 twice on the last day (tie), a JSON float price, a quoted code
    write_json(
        f"{ide}/2020_03_01_idealista.json",
        [
            listing(1, price="149000.0", parkingSpace={"hasParkingSpace": True, "isParkingSpaceIncludedInPrice": False, "parkingSpacePrice": 15000.0}),
            listing(1, price=150000, floor=3),
            listing("921", "l'Antiga Esquerra", 300000),
            listing(5, "Nowhere", 999),
            listing(6, None, 1),
        ],
    )
    # snapshot 3 without neighborhood column at all, and an empty file
    write_json(f"{ide}/2021_01_01_idealista.json", [listing(7, None, 5)])
    write_json(f"{ide}/2021_02_01_idealista.json", [])
    # rent: two files with columns in a different order
    write_text(
        f"{root}/opendata-rent/2020_lloguer_preu_trim.csv",
        "Any,Trimestre,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Lloguer_mitja,Preu\n"
        f"2020,1,6,Gràcia,31,Gràcia,{RENT_LABEL},700\n"
        f"2020,2,6,Gràcia,31,Gràcia,{RENT_LABEL},--\n"
        f"2020,3,6,Gràcia,31,Gràcia,{RENT_LABEL},NA\n"
        f"2020,4,6,Gràcia,31,Gràcia,{RENT_LABEL},\n"
        f"2020,1,6,Gràcia,31,Gràcia,{AREA_LABEL},15.2\n"
        f"2020,1,7,Horta-Guinardó,43,\"Horta, Barcelona\",{RENT_LABEL},800\n",
    )
    write_text(
        f"{root}/opendata-rent/2021_lloguer_preu_trim.csv",
        "Nom_Barri,Any,Trimestre,Codi_Districte,Nom_Districte,Codi_Barri,Lloguer_mitja,Preu\n"
        f"l'Antiga Esquerra,2020,1,3,Sants-Montjuïc,8,{RENT_LABEL},0\n"
        f"Gràcia,2021,1,6,Gràcia,31,{RENT_LABEL},nan\n",
    )
    write_text(
        f"{root}/opendatabcn-income/2020_income.csv",
        "\ufeffAny,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Població,Índex RFD Barcelona = 100\n"
        "2020,6,Gràcia,31,Gràcia,51000,110.5\n"
        "2020,7,Horta-Guinardó,43,\"Horta, Barcelona\",8000,-\n"
        "2020,9,Nowhere,99,Nowhere,10,1\n",
    )
    write_text(f"{root}/lookup_tables/lookup.csv", LOOKUP_CSV)
