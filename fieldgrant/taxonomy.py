"""Support schemes: published label -> English name, group and canonical slug."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Scheme(NamedTuple):
    raw_code: str
    english: str
    group_name: str
    slug: str


# Slug of schemes that are not listed below.
OTHER_SLUG = "other_rural_development"

# Group names.
DIRECT = "Direct Income Support"
MARKET = "Sectoral & Market Support"
CLIMATE = "Agri-Environment & Climate"
FOREST = "Forestry & Silviculture"
RURAL = "Rural Development & Investments"
KNOWLEDGE = "Knowledge & Innovation"
TECHNICAL = "Technical Assistance"
CRISIS = "Emergency Crisis Aid"

# The published labels, matched exactly (three spaces after the code included).
SCHEMES = (
    Scheme("I.1   Ayuda básica a la renta para la sostenibilidad", "Basic Income Support for Sustainability", DIRECT, "direct_payment_biss"),
    Scheme("I.2   Ayuda redistributiva complementaria a la renta para la sostenibilidad", "Complementary Redistributive Income Support for Sustainability", DIRECT, "redistributive_support"),
    Scheme("I.3   Ayuda complementaria a la renta para jóvenes agricultores", "Complementary Income Support for Young Farmers", DIRECT, "young_farmer_income"),
    Scheme("I.6   Ayuda a la renta asociada", "Coupled Income Support", DIRECT, "coupled_income_support"),
    Scheme("I.7   Pago específico al cultivo del algodón", "Crop-Specific Payment for Cotton", DIRECT, "cotton_payment"),
    Scheme("II.1   Régimen de pago básico", "Basic Payment Scheme", DIRECT, "direct_payment_biss"),
    Scheme("II.6   Pago para los jóvenes agricultores", "Payment for Young Farmers", DIRECT, "young_farmer_income"),
    Scheme("II.7   Ayuda asociada voluntaria", "Voluntary Coupled Support", DIRECT, "coupled_income_support"),
    Scheme("II.8   Pago específico al cultivo de algodón", "Crop-Specific Payment for Cotton", DIRECT, "cotton_payment"),
    Scheme("II.9   Régimen para los pequeños agricultores", "Small Farmers Scheme", DIRECT, "small_farmers_scheme"),
    Scheme("II.10   Medidas establecidas en el anexo I del Reglamento 73/2009", "Measures under Annex I of Regulation (EC) No 73/2009", DIRECT, "direct_support_legacy"),
    Scheme("II.11   Recuperaciones", "Recoveries and Adjustments", DIRECT, "direct_support_legacy"),
    Scheme("III.1   En el sector de las frutas y hortalizas", "Fruit and Vegetables Sector Interventions", MARKET, "fruit_veg_support"),
    Scheme("III.2   En el sector de los productos apícolas", "Apiculture Sector Products", MARKET, "apiculture_support"),
    Scheme("III.3   En el sector vitivinícola", "Wine Sector Interventions", MARKET, "wine_sector_support"),
    Scheme("IV.3   El programa escolar de la UE, los programas de fruta y de leche en los centros escolares", "EU School Scheme for Fruit, Vegetables, and Milk", MARKET, "school_nutrition_program"),
    Scheme("IV.4   Reserva agrícola de crisis", "Agricultural Crisis Reserve", MARKET, "crisis_reserve"),
    Scheme("IV.5   Ayuda en el sector de las frutas y hortalizas", "Aid in the Fruit and Vegetables Sector", MARKET, "fruit_veg_support"),
    Scheme("IV.6   Ayuda en el sector vitivinícola", "Aid in the Wine Sector", MARKET, "wine_sector_support"),
    Scheme("IV.8   Ayuda en el sector apícola", "Aid in the Apiculture Sector", MARKET, "apiculture_support"),
    Scheme("VII.1   Medidas establecidas en el Reglamento 228/2013", "Measures under Regulation (EU) No 228/2013 (POSEI Canary Islands)", MARKET, "outermost_regions_posei"),
    Scheme("IX.1   Medidas de información y de promoción", "Information and Promotion Measures", MARKET, "market_food_promotion"),
    Scheme("I.4   Regímenes en favor del clima y el medio ambiente", "Schemes for Climate and Environment (Eco-schemes)", CLIMATE, "eco_schemes"),
    Scheme("II.4   Pago para prácticas agrícolas beneficiosas para el clima y el medio ambiente", "Payment for Climate-Beneficial Practices (Greening)", CLIMATE, "eco_schemes"),
    Scheme("V.1   Compromisos medioambientales y climáticos y otros compromisos de gestión", "Environmental, Climate, and Other Management Commitments", CLIMATE, "agri_environmental_commitments"),
    Scheme("V.2   Zonas con limitaciones naturales u otras limitaciones específicas", "Areas Facing Natural or Other Specific Constraints", CLIMATE, "natural_constraints_anc"),
    Scheme("V.3   Desventajas específicas resultantes de determinados requisitos obligatorios", "Specific Disadvantages from Mandatory Requirements", CLIMATE, "natura_2000_disadvantages"),
    Scheme("VI.15   Medida agroambiental y climática", "Agri-Environment-Climate Measure", CLIMATE, "agri_environmental_commitments"),
    Scheme("VI.16   Agricultura ecológica", "Organic Farming", CLIMATE, "organic_farming"),
    Scheme("VI.17   Pagos al amparo de Natura 2000 y de la Directiva Marco del Agua", "Payments under Natura 2000 and Water Framework Directive", CLIMATE, "natura_2000_disadvantages"),
    Scheme("VI.18   Ayuda a zonas con limitaciones naturales u otras limitaciones específicas", "Aid to Areas Facing Natural or Other Specific Constraints", CLIMATE, "natural_constraints_anc"),
    Scheme("VI.19   Bienestar de los animales", "Animal Welfare", CLIMATE, "livestock_welfare_and_support"),
    Scheme("VI.8   Inversiones en el desarrollo de zonas forestales y la mejora de la viabilidad de los bosques", "Investments in Forest Area Development and Viability", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.9   Forestación y creación de superficies forestales", "Afforestation and Creation of Woodland", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.10   Implantación, regeneración o renovación de sistemas agroforestales", "Establishment, Regeneration, or Renewal of Agroforestry Systems", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.11   Prevención y reparación de los daños causados a los bosques por incendios, desastres naturales y catástrofes", "Prevention and Repair of Forest Damage from Fires and Natural Disasters", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.12   Inversiones para incrementar la capacidad de adaptación y el valor medioambiental de los ecosistemas forestales", "Investments to Increase Forest Resilience and Environmental Value", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.13   Inversiones en tecnologías forestales y en la transformación, movilización y comercialización de productos forestales", "Investments in Forestry Technologies, Processing, and Marketing", FOREST, "forestry_and_agroforestry"),
    Scheme("VI.20   Servicios silvoambientales y climáticos y la conservación de los bosques", "Silvo-Environmental and Climate Services and Forest Conservation", FOREST, "forestry_and_agroforestry"),
    Scheme("22400 - Monzón", "Monzón Regional Irrigation Infrastructure Project", RURAL, "physical_capital_investments"),
    Scheme("M.113   Jubilación anticipada", "Early Retirement Scheme", RURAL, "early_retirement_legacy"),
    Scheme("V.4   Inversiones, incluidas las inversiones en infraestructuras de riego", "Investments, Including Irrigation Infrastructure", RURAL, "physical_capital_investments"),
    Scheme("V.5   Establecimiento de jóvenes agricultores, nuevos agricultores y puesta en marcha de nuevas empresas rurales", "Setting Up of Young Farmers, New Farmers, and Rural Startups", RURAL, "rural_business_startup"),
    Scheme("VI.3   Regímenes de calidad de los productos agrícolas y alimenticios", "Quality Schemes for Agricultural Products and Foodstuffs", RURAL, "quality_schemes"),
    Scheme("VI.4   Inversiones en activos físicos", "Investments in Physical Assets", RURAL, "physical_capital_investments"),
    Scheme("VI.5   Recuperación del potencial de producción agrícola dañado por desastres naturales e implantación de medidas preventivas adecuadas", "Restoration of Agricultural Production Potential Damaged by Disasters", RURAL, "agricultural_disaster_recovery"),
    Scheme("VI.6   Desarrollo de explotaciones agrícolas y empresas", "Farm and Business Development", RURAL, "rural_business_startup"),
    Scheme("VI.7   Servicios básicos y renovación de poblaciones en las zonas rurales", "Basic Services and Village Renewal in Rural Areas", RURAL, "village_renewal_infra"),
    Scheme("VI.14   Creación de agrupaciones y organizaciones de productores", "Setting Up Producer Groups and Organizations", RURAL, "producer_org_aid"),
    Scheme("VI.24   Ayuda para el desarrollo local de Leader (desarrollo local participativo)", "Aid for LEADER Local Development (CLLD)", RURAL, "leader_community_dev"),
    Scheme("V.7   Cooperación", "Cooperation Projects", KNOWLEDGE, "cooperation_innovation"),
    Scheme("V.8   Intercambio de conocimientos y difusión de información", "Knowledge Exchange and Information Dissemination", KNOWLEDGE, "knowledge_transfer_training"),
    Scheme("V.9   Asistencia Técnica (calculado con la tasa media del Plan Estratégico PAC)", "Technical Assistance (Strategic Plan Rate)", TECHNICAL, "technical_assistance_eafrd"),
    Scheme("VI.1   Transferencia de conocimientos y actividades de información", "Knowledge Transfer and Information Actions", KNOWLEDGE, "knowledge_transfer_training"),
    Scheme("VI.2   Servicios de asesoramiento, gestión y sustitución de explotaciones agrarias", "Farm Advisory, Management, and Relief Services", KNOWLEDGE, "farm_advisory_services"),
    Scheme("VI.21   Cooperación", "Cooperation", KNOWLEDGE, "cooperation_innovation"),
    Scheme("VI.22b   Ayuda temporal excepcional destinada a los agricultores y a las pymes especialmente afectados por la invasión de Ucrania por parte de Rusia", "Exceptional Temporary Support (Ukraine War Impact)", CRISIS, "emergency_crisis_aid"),
    Scheme("VI.25   Asistencia técnica", "Technical Assistance", TECHNICAL, "technical_assistance_eafrd"),
)

# A taxonomy is reference data; up to this many labels it is small enough to send to every task.
BROADCAST_LABELS = 100_000


def slugs(schemes: Sequence[Scheme] = SCHEMES) -> list[str]:
    """All canonical slugs, sorted, the catch-all last: the stable column order of wide tables."""
    return sorted({s.slug for s in schemes} - {OTHER_SLUG}) + [OTHER_SLUG]


def taxonomy_frame(spark: SparkSession, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    return spark.createDataFrame(list(schemes), "raw_code string, english string, group_name string, slug string")
