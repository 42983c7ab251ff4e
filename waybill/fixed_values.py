"""Fixed values.

Everything here is data that has to come out byte for byte the same on every run:
record-type names, column names as published, code labels, dimension rows, column
descriptions and table comments (Portuguese, as the published data set uses them).
No logic lives in this file.
"""

# --- fixed values: column-name handling -------------------------------------------
NAME_OVERRIDES = {
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "PUlocationID": "pu_location_id",
    "DOlocationID": "do_location_id",
}

PICKUP_COLUMNS = ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")
DROPOFF_COLUMNS = (
    "tpep_dropoff_datetime",
    "lpep_dropoff_datetime",
    "dropoff_datetime",
    "drop_off_datetime",
)
PICKUP_LOCATION = "pu_location_id"
DROPOFF_LOCATION = "do_location_id"
AIRPORT_SERVICE_ZONE = "Airports"

# --- fixed values: code labels used in silver ---------------------------------------
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
}
RATECODE_NAMES = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negociada",
    6: "Group ride",
}
PAYMENT_TYPE_NAMES = {
    1: "Cartao de credito",
    2: "Dinheiro",
    3: "Sem cobranca",
    4: "Disputa",
    5: "Desconhecido",
    6: "Corrida anulada",
}
HVFHS_LICENSE_NAMES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}

# --- fixed values: rows of the code dimensions ---------------------------------------
SERVICE_TYPE_ROWS = (
    (1, "yellow", "Yellow Taxi"),
    (2, "green", "Green Taxi"),
    (3, "fhv", "For-Hire Vehicle"),
    (4, "fhvhv", "High-Volume For-Hire Vehicle"),
)
VENDOR_ROWS = (
    (0, "Desconhecido"),
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
)
RATE_CODE_ROWS = (
    (0, "Desconhecido"),
    (1, "Standard"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau/Westchester"),
    (5, "Negociada"),
    (6, "Group ride"),
)
PAYMENT_TYPE_ROWS = (
    (0, "Nao informado"),
    (1, "Cartao de credito"),
    (2, "Dinheiro"),
    (3, "Sem cobranca"),
    (4, "Disputa"),
    (5, "Desconhecido"),
    (6, "Corrida anulada"),
)
HVFHS_LICENSE_ROWS = (
    (0, "N/A", "Nao aplicavel"),
    (1, "HV0002", "Juno"),
    (2, "HV0003", "Uber"),
    (3, "HV0004", "Via"),
    (4, "HV0005", "Lyft"),
)
UNKNOWN_ZONE_ROW = (-1, -1, "Unknown", "Unknown", "Unknown")
UNKNOWN_ZONE_KEY = -1
UNKNOWN_CODE_KEY = 0

# last hour of each part of the day, with its label
DAY_PERIODS = ((5, "Madrugada"), (11, "Manha"), (17, "Tarde"), (23, "Noite"))

# --- fixed values: consumption contract ----------------------------------------------
CONTRACT_COLUMNS = (
    "vendor_id",
    "passenger_count",
    "total_amount",
    "pickup_datetime",
    "dropoff_datetime",
)
CONTRACT_OK = (
    "Contrato de consumo OK: VendorID, passenger_count, total_amount, "
    "pickup_datetime e dropoff_datetime presentes."
)
CONTRACT_BROKEN = (
    "Contrato de consumo violado: colunas obrigatorias ausentes em fact_trips -> "
)

# --- fixed values: table comments ------------------------------------------------------
TABLE_COMMENTS = {
    "dim_service_type": "Tipo de servico de taxi (yellow/green/fhv/fhvhv).",
    "dim_vendor": "Provedor do registro (TPEP/LPEP). Chave 0 = desconhecido.",
    "dim_rate_code": "Codigo de tarifa vigente no fim da corrida. Chave 0 = desconhecido.",
    "dim_payment_type": "Forma de pagamento. Chave 0 = nao informado.",
    "dim_hvfhs_license": "Empresa HVFHS (fhvhv). Chave 0 = nao aplicavel.",
    "dim_zone": "Dimensao de zonas TLC (role-playing: embarque/desembarque). Chave -1 = desconhecida.",
    "dim_time": "Dimensao de hora do dia (0-23) com periodo do dia.",
    "dim_date": "Dimensao de calendario (grao = dia) cobrindo o periodo carregado no silver.",
    "fact_trips": "Fato de corridas (grao = 1 corrida) unificando os quatro tipos de taxi.",
    "agg_revenue_monthly": "Metricas mensais por tipo de servico. Responde a media de total_amount por mes.",
    "agg_trips_by_hour": "Metricas por hora do dia e mes por tipo. Responde a media de passenger_count por hora.",
    "agg_trips_by_zone": "Metricas por borough/zona de embarque e tipo de servico.",
    "cube_trips": "Cubo OLAP: subtotais por service_type/year/month/hour/pickup_borough/payment_type via GROUP BY CUBE.",
}

# --- fixed values: column descriptions, as published --------------------------------
YELLOW_COMMENTS = {
    "VendorID": "Codigo do provedor TPEP que gerou o registro. 1=Creative Mobile Technologies; 2=VeriFone Inc.",
    "tpep_pickup_datetime": "Data e hora em que o taximetro foi acionado (inicio da corrida).",
    "tpep_dropoff_datetime": "Data e hora em que o taximetro foi desligado (fim da corrida).",
    "passenger_count": "Numero de passageiros no veiculo (valor informado pelo motorista).",
    "trip_distance": "Distancia da corrida em milhas reportada pelo taximetro.",
    "RatecodeID": "Codigo de tarifa vigente no fim da corrida. 1=Standard; 2=JFK; 3=Newark; 4=Nassau/Westchester; 5=Negociada; 6=Group ride.",
    "store_and_fwd_flag": "Indica se o registro ficou na memoria do veiculo antes do envio (store-and-forward). Y=sim; N=nao.",
    "PULocationID": "TLC Taxi Zone onde o taximetro foi acionado (embarque).",
    "DOLocationID": "TLC Taxi Zone onde o taximetro foi desligado (desembarque).",
    "payment_type": "Forma de pagamento. 1=Cartao de credito; 2=Dinheiro; 3=Sem cobranca; 4=Disputa; 5=Desconhecido; 6=Corrida anulada.",
    "fare_amount": "Tarifa de tempo-e-distancia calculada pelo taximetro.",
    "extra": "Extras e sobretaxas diversas (ex.: US$0,50 e US$1 de horario de pico/noturno).",
    "mta_tax": "Taxa MTA de US$0,50 acionada automaticamente pela tarifa em uso.",
    "tip_amount": "Valor da gorjeta (preenchido automaticamente para cartao; nao inclui gorjetas em dinheiro).",
    "tolls_amount": "Total de pedagios pagos na corrida.",
    "improvement_surcharge": "Sobretaxa de melhoria de US$0,30 cobrada no inicio da corrida (desde 2015).",
    "total_amount": "Valor total cobrado dos passageiros (nao inclui gorjetas em dinheiro).",
    "congestion_surcharge": "Total arrecadado da sobretaxa de congestionamento do estado de NY.",
    "airport_fee": "Taxa de US$1,25 para embarques em LaGuardia e JFK.",
}

GREEN_COMMENTS = {
    "VendorID": "Codigo do provedor LPEP que gerou o registro. 1=Creative Mobile Technologies; 2=VeriFone Inc.",
    "lpep_pickup_datetime": "Data e hora em que o taximetro foi acionado (inicio da corrida).",
    "lpep_dropoff_datetime": "Data e hora em que o taximetro foi desligado (fim da corrida).",
    "passenger_count": "Numero de passageiros no veiculo (valor informado pelo motorista).",
    "trip_distance": "Distancia da corrida em milhas reportada pelo taximetro.",
    "RatecodeID": "Codigo de tarifa vigente no fim da corrida. 1=Standard; 2=JFK; 3=Newark; 4=Nassau/Westchester; 5=Negociada; 6=Group ride.",
    "store_and_fwd_flag": "Indica se o registro ficou na memoria do veiculo antes do envio (store-and-forward). Y=sim; N=nao.",
    "PULocationID": "TLC Taxi Zone onde o taximetro foi acionado (embarque).",
    "DOLocationID": "TLC Taxi Zone onde o taximetro foi desligado (desembarque).",
    "payment_type": "Forma de pagamento. 1=Cartao de credito; 2=Dinheiro; 3=Sem cobranca; 4=Disputa; 5=Desconhecido; 6=Corrida anulada.",
    "fare_amount": "Tarifa de tempo-e-distancia calculada pelo taximetro.",
    "extra": "Extras e sobretaxas diversas (ex.: horario de pico/noturno).",
    "mta_tax": "Taxa MTA de US$0,50 acionada automaticamente pela tarifa em uso.",
    "tip_amount": "Valor da gorjeta (preenchido automaticamente para cartao; nao inclui gorjetas em dinheiro).",
    "tolls_amount": "Total de pedagios pagos na corrida.",
    "ehail_fee": "Taxa de e-hail (chamado eletronico), quando aplicavel.",
    "improvement_surcharge": "Sobretaxa de melhoria de US$0,30 cobrada no inicio da corrida (desde 2015).",
    "total_amount": "Valor total cobrado dos passageiros (nao inclui gorjetas em dinheiro).",
    "payment_type_desc": "Descricao da forma de pagamento.",
    "trip_type": "Tipo de corrida atribuido pela tarifa em uso. 1=Street-hail; 2=Dispatch.",
    "congestion_surcharge": "Total arrecadado da sobretaxa de congestionamento do estado de NY.",
}

FHV_COMMENTS = {
    "dispatching_base_num": "Numero da licenca TLC da base que despachou a corrida.",
    "pickup_datetime": "Data e hora de inicio da corrida.",
    "dropOff_datetime": "Data e hora de fim da corrida.",
    "PUlocationID": "TLC Taxi Zone de embarque.",
    "DOlocationID": "TLC Taxi Zone de desembarque.",
    "SR_Flag": "Indica corridas que fazem parte de uma cadeia de viagem compartilhada (shared ride). 1=compartilhada; nulo caso contrario.",
    "Affiliated_base_number": "Numero da licenca TLC da base afiliada ao veiculo.",
}

FHVHV_COMMENTS = {
    "hvfhs_license_num": "Numero da licenca TLC da base/empresa HVFHS. HV0002=Juno; HV0003=Uber; HV0004=Via; HV0005=Lyft.",
    "dispatching_base_num": "Numero da licenca TLC da base que despachou a corrida.",
    "originating_base_num": "Numero da licenca TLC da base que recebeu a solicitacao original.",
    "request_datetime": "Data e hora em que o passageiro solicitou a corrida.",
    "on_scene_datetime": "Data e hora em que o motorista chegou ao local de embarque.",
    "pickup_datetime": "Data e hora de inicio da corrida.",
    "dropoff_datetime": "Data e hora de fim da corrida.",
    "PULocationID": "TLC Taxi Zone de embarque.",
    "DOLocationID": "TLC Taxi Zone de desembarque.",
    "trip_miles": "Milhas percorridas com o passageiro.",
    "trip_time": "Tempo total (segundos) da corrida com o passageiro.",
    "base_passenger_fare": "Tarifa base do passageiro, antes de pedagios, gorjetas, impostos e taxas.",
    "tolls": "Total de pedagios pagos na corrida.",
    "bcf": "Black Car Fund arrecadado na corrida.",
    "sales_tax": "Imposto de vendas do estado de NY arrecadado na corrida.",
    "congestion_surcharge": "Sobretaxa de congestionamento do estado de NY arrecadada.",
    "airport_fee": "Taxa de aeroporto para embarque/desembarque em LaGuardia, Newark e JFK.",
    "tips": "Gorjeta paga pelo passageiro.",
    "driver_pay": "Pagamento total ao motorista (sem gorjetas).",
    "shared_request_flag": "Passageiro concordou com corrida compartilhada. Y/N.",
    "shared_match_flag": "Corrida efetivamente compartilhada com outro passageiro. Y/N.",
    "access_a_ride_flag": "Corrida administrada em nome da MTA (Access-A-Ride). Y/N.",
    "wav_request_flag": "Passageiro solicitou veiculo acessivel a cadeira de rodas (WAV). Y/N.",
    "wav_match_flag": "Corrida atendida por veiculo acessivel a cadeira de rodas (WAV). Y/N.",
}

ZONE_COMMENTS = {
    "location_id": "Identificador da TLC Taxi Zone (1-265). Chave usada em pu_location_id/do_location_id.",
    "borough": "Distrito (borough) ao qual a zona pertence (ex.: Manhattan, Queens).",
    "zone": "Nome da zona (bairro/regiao) da TLC.",
    "service_zone": "Zona de servico: EWR, Boro Zone, Yellow Zone ou Airports.",
}

SILVER_DERIVED_COMMENTS = {
    "pickup_year": "Ano do embarque, derivado da coluna de pickup (particao).",
    "pickup_month": "Mes do embarque, derivado da coluna de pickup (particao).",
    "pickup_borough": "Borough de embarque (join com taxi_zone_lookup por pu_location_id).",
    "pickup_zone": "Zona de embarque (join com taxi_zone_lookup por pu_location_id).",
    "pickup_service_zone": "Zona de servico de embarque (join com taxi_zone_lookup).",
    "dropoff_borough": "Borough de desembarque (join com taxi_zone_lookup por do_location_id).",
    "dropoff_zone": "Zona de desembarque (join com taxi_zone_lookup por do_location_id).",
    "dropoff_service_zone": "Zona de servico de desembarque (join com taxi_zone_lookup).",
    "is_airport_trip": "Verdadeiro quando embarque ou desembarque ocorre em zona de aeroporto (service_zone = 'Airports').",
}

SILVER_LABEL_COMMENTS = {
    "vendor_name": "Nome do provedor correspondente a vendor_id (1=Creative Mobile Technologies; 2=VeriFone Inc.).",
    "ratecode_name": "Descricao do codigo de tarifa correspondente a ratecode_id (1=Standard; 2=JFK; 3=Newark; 4=Nassau/Westchester; 5=Negociada; 6=Group ride).",
    "payment_type_name": "Descricao da forma de pagamento correspondente a payment_type (1=Cartao de credito; 2=Dinheiro; 3=Sem cobranca; 4=Disputa; 5=Desconhecido; 6=Corrida anulada).",
    "hvfhs_license_name": "Nome da empresa HVFHS correspondente a hvfhs_license_num (HV0002=Juno; HV0003=Uber; HV0004=Via; HV0005=Lyft).",
}

SILVER_FLAG_COMMENTS = {
    "store_and_fwd_flag": "Registro em store-and-forward (ficou na memoria do veiculo antes do envio), convertido para boolean (Y->true, N->false).",
    "shared_request_flag": "Passageiro concordou com corrida compartilhada, convertido para boolean (Y->true, N->false).",
}
