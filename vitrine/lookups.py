"""Fixed dictionaries. Their order decides ties, so lists stay in natural order."""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
PRICE_EDGES = [0.0, 30000.0, 50000.0, 80000.0, 120000.0]
PRICE_LABELS = ["Até 30k", "30k-50k", "50k-80k", "80k-120k", "120k+"]

KM_EDGES = [0.0, 30000.0, 60000.0, 100000.0, 150000.0]
KM_LABELS = ["Até 30k km", "30k-60k km", "60k-100k km", "100k-150k km", "150k+ km"]

STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG",
    "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

CITIES = [
    "Rio de Janeiro", "São Paulo", "Belo Horizonte", "Brasília", "Salvador",
    "Fortaleza", "Curitiba", "Manaus", "Recife", "Goiânia", "Belém", "Porto Alegre",
    "Guarulhos", "Campinas", "São Luís", "São Gonçalo", "Maceió", "Duque de Caxias",
    "Natal", "Teresina", "São Bernardo do Campo", "São Bernardo", "Nova Iguaçu",
    "Campo Grande", "Osasco", "Santo André", "João Pessoa", "Jaboatão dos Guararapes",
    "Contagem", "São José dos Campos", "São José", "Uberlândia", "Sorocaba",
    "Ribeirão Preto", "Cuiabá", "Aracaju", "Feira de Santana", "Joinville",
    "Juiz de Fora", "Londrina", "Aparecida de Goiânia", "Ananindeua", "Porto Velho",
    "Serra", "Niterói", "Belford Roxo", "Caxias do Sul", "Campos dos Goytacazes",
    "Macapá", "Florianópolis", "Vila Velha", "Mauá", "São João de Meriti",
    "São José do Rio Preto", "Mogi das Cruzes", "Betim", "Santos", "Diadema",
    "Maringá", "Jundiaí", "Campina Grande", "Montes Claros", "Rio Branco",
    "Piracicaba", "Carapicuíba", "Olinda", "Anápolis", "Cariacica", "Bauru",
    "Itaquaquecetuba", "São Vicente", "Vitória", "Pelotas", "Caucaia", "Canoas",
    "Caruaru", "Franca", "Ponta Grossa", "Blumenau", "Petrolina", "Paulista",
    "Vitória da Conquista", "Cascavel", "Santarém", "Uberaba", "Petrópolis",
    "Mogi Guaçu", "Várzea Grande", "Lauro de Freitas", "São José", "Limeira",
]

# Cities of several words that the address split recognises.
SPLIT_CITIES = ["Rio de Janeiro", "São Paulo", "São Bernardo do Campo", "São José dos Campos"]

# "Mercedes-Benz" stands before "Mercedes" so that the longer name wins.
BRANDS = [
    "Ferrari", "Audi", "BMW", "Mercedes-Benz", "Mercedes", "Porsche", "Lamborghini",
    "Volkswagen", "Fiat", "Renault", "Hyundai", "Toyota", "Jeep",
    "Chevrolet", "Citroen", "Peugeot", "Nissan", "Volvo", "Ford",
    "Honda", "Mini", "Mitsubishi", "Caoa Chery",
]

# (dealer, city, state, district)
DEALERS = [
    ("Auto Shopping Shopping Car", "Rio de Janeiro", "RJ", "Barra da Tijuca"),
    ("Auto Shopping Portal", "Contagem", "MG", "Babita Camargo"),
    ("Auto Shopping Autonomistas", "Osasco", "SP", "Vila Yara"),
    ("Auto Shopping Raposo", "São Paulo", "SP", "Butantã"),
    ("Auto Shopping Bandeirantes", "São Paulo", "SP", "Limão"),
    ("Auto Shopping Mundo Car", "São José", "SC", "Kobrasol"),
    ("Auto Shopping Natal", "Natal", "RN", "Candelária"),
    ("Auto Shopping Campina", "Campina Grande", "PB", "Catolé"),
    ("Auto Shopping Lauro de Freitas", "Lauro de Freitas", "BA", "Estrada do Coco"),
    ("Auto Shopping Tamboré", "Barueri", "SP", "Alphaville"),
    ("Auto Shopping Arena Motors", "São Paulo", "SP", "Vila Guilherme"),
    ("Auto Shopping Passeio das Águas", "Goiânia", "GO", "Residencial Humaitá"),
    ("Auto Shopping Show Auto Mall", "Contagem", "MG", "Cidade Industrial"),
    ("Auto Shopping Rodrigues", "Salvador", "BA", "Paralela"),
    ("Auto Shopping Fortaleza", "Fortaleza", "CE", "Papicu"),
    ("Auto Shopping Fórmula", "Várzea Grande", "MT", "Centro"),
]

# Patterns of words that are no part of a place. The name of the listing site itself is
# junk as well; callers pass it as `site_names`.
JUNK_PATTERNS = [
    r"BAIXO\s*KM", r"SEMINOVOS", r"OFERTA", r"ESPECIAL",
    r"IPVA\s*\d*\s*PAGO", r"ÚNICO\s*DONO", r"LICENCIADO",
]

# Words that open a shop name, and words from which the rest is a street or district.
SHOP_PREFIXES = [r"Auto\s+Shopping", r"Shopping", r"Auto"]
ADDRESS_WORDS = [r"Av\.", "Rua", "Bairro", "Vila", "Jardim", "Miguel", "Pereira"]

# A line holding one of these states payment conditions.
CONDITION_WORDS = ["parcela", "condição", "entrada"]
PURCHASE_FLAG = "COMPRA_ONLINE"
ONLINE_MARKERS = ["RESERVAR ONLINE", "COMPRA ONLINE"]
# ------------------------------------------------------------------------------

# Texts a profile document ends with.
INSIGHTS = [
    "Preço médio por marca",
    "Distribuição geográfica",
    "Correlação preço vs quilometragem",
    "Faixas de preço mais populares",
    "Idade média dos veículos por marca",
]
