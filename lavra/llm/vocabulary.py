"""Words of court fee tables and expert registers: fixed values of the field, passed to the mapping of typed values as ``COURT``."""

from __future__ import annotations

from lavra.llm.canonical import Knowledge

#: Words that say nothing about which entry is meant.
FILLERS = frozenset(
    "de da do das dos e em com c por p para pra ou no na nos nas a o os ao s n "
    "perito perita dr dra sr sra profissional especialista especialidade tec tecnico tecnica area ramo reg registro crx xx nomeado nomeada autos "
    "honorarios honorario item pericia pericial laudo ref referente servicos".split()
)

#: Spelling of the canonical word, then the words that stand for it.
STEMS = {
    "engenharia": "engenheiro engenheira eng engo enga", "medicina": "medico medica med", "eletrica": "eletricista eletrico eletricas", "mecanica": "mecanico",
    "ambiental": "ambientalista", "seguranca": "seg", "agronomica": "agronomo agronoma agronomia agronomico", "cartografica": "cartografo cartografa cartografia cartografico",
    "arquitetura": "arquiteto arquiteta arq", "urbanismo": "urbanista urb", "topografia": "topografo topografa topografico", "avaliacao": "avaliador avaliadora aval",
    "imobiliaria": "imobiliario imoveis", "contabilidade": "contador contadora contabil contabeis contabilista", "economia": "economista economicas economico",
    "atuaria": "atuario atuaria atuariais atuarial", "administracao": "administrador administradora adm", "grafotecnica": "grafotecnico grafoscopia grafoscopico grafotecnia grafologia",
    "documentoscopia": "documentoscopista documentoscopico documentoscopica", "papiloscopia": "papiloscopista papiloscopico papiloscopica", "psicologia": "psicologo psicologa",
    "pedagogia": "pedagogo pedagoga", "psicopedagogia": "psicopedagogo psicopedagoga", "entrevista": "entrevistador entrevistadora", "psiquiatria": "psiquiatra",
    "ortopedia": "ortopedista", "neurologia": "neurologista", "cardiologia": "cardiologista", "oftalmologia": "oftalmologista", "pediatria": "pediatra",
    "ginecologia": "ginecologista", "dermatologia": "dermatologista", "legal": "legista", "clinica": "clinico", "odontologia": "odontologo odontologa dentista odonto",
    "fisioterapia": "fisioterapeuta fisio", "fonoaudiologia": "fonoaudiologo fonoaudiologa fono", "terapia": "terapeuta", "nutricao": "nutricionista",
    "enfermagem": "enfermeiro enfermeira", "veterinaria": "veterinario", "genetica": "geneticista dna", "quimica": "quimico", "farmacia": "farmaceutico farmaceutica",
    "biologia": "biologo biologa", "geologia": "geologo geologa", "informatica": "info", "traducao": "tradutor tradutora", "juramentada": "juramentado",
    "comercial": "coml", "hectares": "ha hectare", "cem": "100", "social": "soc", "assistente": "assist as assistencia",
}

#: Other ways to write an entry, by the entry's name.
ALIASES = {
    "Engenharia de Segurança do Trabalho": ["engenharia segurança", "segurança trabalho"],
    "Engenharia Agronômica": ["agronômica"], "Engenharia Elétrica": ["eletricista"], "Engenharia Cartográfica": ["cartógrafo"],
    "Arquitetura e Urbanismo": ["arquiteto"],
    "Avaliação Imobiliária": ["corretor avaliador imóveis", "corretor imóveis", "avaliador"],
    "Contabilidade": ["ciências contábeis"], "Economia": ["ciências econômicas"], "Atuária": ["ciências atuariais"],
    "Administração": ["administração empresas"], "Psicologia": ["psicologia forense", "psicologia jurídica"],
    "Serviço Social": ["assistente social"], "Entrevista Forense": ["entrevistador"],
    "Medicina - Psiquiatria": ["psiquiatria"], "Medicina - Ortopedia": ["ortopedia", "ortopedia traumatologia", "medicina ortopedia traumatologia"],
    "Medicina - Neurologia": ["neurologia"], "Medicina - Cardiologia": ["cardiologia"], "Medicina - Oftalmologia": ["oftalmologia"],
    "Medicina - Pediatria": ["pediatria"], "Medicina - Ginecologia": ["ginecologia"], "Medicina - Dermatologia": ["dermatologia"],
    "Medicina Legal": ["legista"], "Clínica Geral": ["medicina clínica geral"],
    "Odontologia": ["cirurgião dentista"], "Medicina Veterinária": ["veterinária"],
    "Genética Forense": ["genética", "exame dna"], "Informática": ["computação forense", "analista sistemas", "computação", "informática forense"],
    "Tradução": ["tradutor juramentado", "intérprete tradutor"], "Libras": ["intérprete libras", "intérprete sinais", "língua sinais"],
}

#: Words of other trades and remarks, which are no misspelling of a word of the list.
OTHER_WORDS = frozenset(
    "teologia teologo naval textil esportiva esportivo musico musica juiz direito zootecnia advogado leiloeiro drone piloto bombeiro designer grafico "
    "diretoria oficial justica estatistico estatistica pesca jornalista guia turismo informado definir combinar publicacao edital custas postagem filmagem "
    "aerea balistico arma diligencia locacao sala guarda veiculo patio outros transporte testemunha astronomia filosofia historia geografia sociologia "
    "militar policial professor secretario motorista cozinheiro ator pintor escritor fotografo dados conta banco agencia conforme nao".split()
)

COURT = Knowledge(FILLERS, STEMS, ALIASES, OTHER_WORDS)
