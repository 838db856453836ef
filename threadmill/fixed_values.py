"""Constants, word lists, lookup tables and patterns that decide results.

Everything in this module is data that has to stay exactly as it is for results to
be right. Tables are written one ``key = value`` pair per line. All of them have
under 200 rows; callers may pass their own tables to every operator instead.
"""

from __future__ import annotations

# Thread titles. The first rule that matches decides the kind.
HIRING_PREFIX = "Ask HN: Who is hiring?"
SEEKERS_PHRASE = "Who wants to be hired?"
FREELANCER_WORD = "Freelancer"
THREAD_KINDS = ("hiring", "seekers", "freelancer", "other")

# English month names, January first.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# Characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# HTML elements that start and end on a line of their own.
BLOCK_TAGS = ("p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6")

# Extraction limits, ledger states and cost assumptions.
SCHEMA_VERSION = 1
MIN_TEXT_CHARS = 50
MAX_TEXT_CHARS = 24_000
PREVIEW_CHARS = 500
MIN_GOLDEN_HTML_CHARS = 100
ATTEMPTS = 3
FIRST_BACKOFF_SECONDS = 2.0
MAX_ERROR_RATE = 0.05
DRY_RUN_INPUT_TOKENS = 500
DRY_RUN_OUTPUT_TOKENS = 200
DEFAULT_MODEL = "gpt-4o-mini"
LEDGER_STATUSES = ("ok", "error", "skipped_empty")

# Salary rules, for yearly amounts.
THOUSANDS_BELOW = 1000
YEARLY_CEILING = 2_000_000

# Eight levels of a text bar chart, lowest first.
LEVEL_GLYPHS = "▁▂▃▄▅▆▇█"

# Closed domains of the document fields.
COMPANY_STAGES = (
    "bootstrapped", "pre_seed", "seed", "series_a",
    "series_b", "series_c_plus", "public", "unstated",
)
YES_NO_UNSTATED = ("yes", "no", "unstated")
WORKPLACE_POLICIES = ("onsite", "remote", "hybrid", "multiple_options", "unstated")
SALARY_PERIODS = ("year", "month", "day", "hour", "unstated")
EQUITY_VALUES = ("yes", "no", "equity_only", "unstated")
TITLE_GUESSES = (
    "software_engineer", "frontend", "backend", "fullstack",
    "ml_engineer", "data_engineer", "data_scientist", "devops_sre",
    "security", "mobile", "embedded", "qa", "product_manager",
    "designer", "engineering_manager", "cto", "founding_engineer", "other",
)
SENIORITIES = (
    "intern", "junior", "mid", "senior", "staff_plus",
    "lead", "manager", "executive", "unstated",
)
EMPLOYMENT_TYPES = ("full_time", "part_time", "contract", "internship", "cofounder", "unstated")
POST_TYPES = ("job_posting", "seeking_work", "meta_or_other")

# Prices in USD per million tokens, input then output.
MODEL_PRICES = (
    ("gpt-4o-mini", 0.15, 0.60),
    ("gpt-4o", 2.50, 10.00),
    ("gpt-4.1-nano", 0.10, 0.40),
    ("gpt-4.1-mini", 0.40, 1.60),
    ("gpt-4.1", 2.00, 8.00),
    ("gpt-5.4-nano", 0.075, 0.30),
)

# Remote regions in order of precedence, with their lower-case phrases.
REMOTE_REGION_RULES = {
    "worldwide": (
        "worldwide", "anywhere in the world", "from anywhere", "global", "fully remote",
        "100% remote", "remote (global)", "remote - global", "remote worldwide",
        "remote anywhere", "international",
    ),
    "us_only": (
        "us only", "usa only", "united states only", "remote us", "remote (us)",
        "remote - us", "us-based", "us residents", "must be us", "within the us",
        "us citizens", "us/canada", "us & canada", "north america only",
    ),
    "eu_only": (
        "eu only", "europe only", "european union", "remote eu", "remote - eu",
        "eu-based", "emea only", "within europe",
    ),
    "timezone_bound": (
        "timezone", "time zone", " est", " pst", " cst", " mst", " cet", " gmt", " utc",
        "eastern time", "pacific time", "central time", "mountain time", "overlap",
        "morning overlap", "business hours", "working hours", "us morning", "us hours",
        "european hours",
    ),
}
OTHER_REGION = "other"


def _pairs(text: str) -> dict[str, str]:
    return dict(line.split(" = ", 1) for line in text.strip().splitlines())


# Currency names and signs.
CURRENCY_ALIASES = _pairs("""
$ = USD
us$ = USD
usd = USD
k$ = USD
us dollars = USD
€ = EUR
eur = EUR
euros = EUR
£ = GBP
gbp = GBP
british pounds = GBP
cad = CAD
cad$ = CAD
c$ = CAD
canadian dollars = CAD
aud = AUD
a$ = AUD
au$ = AUD
australian dollars = AUD
sgd = SGD
s$ = SGD
inr = INR
₹ = INR
brl = BRL
r$ = BRL
chf = CHF
sfr = CHF
nok = NOK
sek = SEK
dkk = DKK
ils = ILS
₪ = ILS
""")

# Country names.
COUNTRY_ALIASES = _pairs("""
usa = US
united states = US
united states of america = US
us = US
america = US
uk = GB
united kingdom = GB
great britain = GB
england = GB
gb = GB
germany = DE
deutschland = DE
france = FR
netherlands = NL
holland = NL
the netherlands = NL
sweden = SE
denmark = DK
norway = NO
finland = FI
switzerland = CH
austria = AT
spain = ES
portugal = PT
italy = IT
poland = PL
czech republic = CZ
czechia = CZ
belgium = BE
ireland = IE
canada = CA
australia = AU
new zealand = NZ
japan = JP
south korea = KR
korea = KR
china = CN
india = IN
singapore = SG
israel = IL
brazil = BR
the eu = EU
europe = EU
""")

# City short forms.
CITY_ALIASES = _pairs("""
sf = San Francisco
san fran = San Francisco
san francisco, ca = San Francisco
nyc = New York
new york city = New York
ny = New York
new york, ny = New York
la = Los Angeles
los angeles, ca = Los Angeles
dc = Washington
washington dc = Washington
washington, dc = Washington
d.c. = Washington
chi = Chicago
chicago, il = Chicago
bos = Boston
boston, ma = Boston
sea = Seattle
seattle, wa = Seattle
atx = Austin
austin, tx = Austin
pdx = Portland
portland, or = Portland
slc = Salt Lake City
salt lake city, ut = Salt Lake City
phx = Phoenix
phoenix, az = Phoenix
mia = Miami
miami, fl = Miami
nyc/sf = New York
""")

# Countries of well-known cities, spelled as written.
CITY_COUNTRIES = _pairs("""
San Francisco = US
New York = US
Los Angeles = US
Chicago = US
Seattle = US
Boston = US
Austin = US
Washington = US
Portland = US
Denver = US
Atlanta = US
Miami = US
Dallas = US
Houston = US
Phoenix = US
San Diego = US
Salt Lake City = US
Minneapolis = US
London = GB
Manchester = GB
Edinburgh = GB
Berlin = DE
Munich = DE
Hamburg = DE
Frankfurt = DE
Amsterdam = NL
Paris = FR
Lyon = FR
Stockholm = SE
Gothenburg = SE
Copenhagen = DK
Oslo = NO
Helsinki = FI
Zurich = CH
Geneva = CH
Vienna = AT
Warsaw = PL
Prague = CZ
Lisbon = PT
Madrid = ES
Barcelona = ES
Toronto = CA
Vancouver = CA
Montreal = CA
Sydney = AU
Melbourne = AU
Brisbane = AU
Singapore = SG
Tokyo = JP
Tel Aviv = IL
Bangalore = IN
Bengaluru = IN
Mumbai = IN
Hyderabad = IN
São Paulo = BR
Sao Paulo = BR
""")

# Technology names. A name mapped to itself is a known name.
TECH_ALIASES = _pairs("""
python = python
javascript = javascript
typescript = typescript
rust = rust
go = go
ruby = ruby
java = java
scala = scala
c++ = c++
c# = csharp
elixir = elixir
haskell = haskell
clojure = clojure
ocaml = ocaml
swift = swift
kotlin = kotlin
dart = dart
lua = lua
perl = perl
r = r
julia = julia
react = react
vue = vue
angular = angular
svelte = svelte
next.js = next.js
nuxt.js = nuxt.js
remix = remix
astro = astro
rails = rails
django = django
flask = flask
fastapi = fastapi
express = express
spring = spring
laravel = laravel
postgresql = postgresql
mysql = mysql
sqlite = sqlite
mongodb = mongodb
redis = redis
elasticsearch = elasticsearch
cassandra = cassandra
dynamodb = dynamodb
s3 = s3
aws = aws
azure = azure
google-cloud = google-cloud
kubernetes = kubernetes
docker = docker
terraform = terraform
ansible = ansible
graphql = graphql
grpc = grpc
kafka = kafka
rabbitmq = rabbitmq
nginx = nginx
linux = linux
sql = sql
node = node
llm = llm
llms = llms
ai = ai
ml = ml
tailwindcss = tailwindcss
distributed systems = distributed systems
golang = go
go lang = go
reactjs = react
react.js = react
react js = react
vuejs = vue
vue.js = vue
vue js = vue
angularjs = angular
angular.js = angular
nodejs = node
node.js = node
node js = node
expressjs = express
express.js = express
nextjs = next.js
next js = next.js
nuxtjs = nuxt.js
nuxt js = nuxt.js
sveltejs = svelte
svelte.js = svelte
postgres = postgresql
psql = postgresql
mongo = mongodb
mongo db = mongodb
es = elasticsearch
elk = elasticsearch
k8s = kubernetes
kube = kubernetes
tf = terraform
js = javascript
ts = typescript
py = python
rb = ruby
ruby on rails = rails
ror = rails
.net = dotnet
asp.net = dotnet
asp.net core = dotnet
gh = github
github actions = github-actions
gcp = google-cloud
google cloud platform = google-cloud
amazon web services = aws
amazon aws = aws
microsoft azure = azure
ms azure = azure
redis cache = redis
apache kafka = kafka
spark = apache-spark
apache spark = apache-spark
dynamo = dynamodb
amazon dynamodb = dynamodb
amazon rds = rds
gql = graphql
rest = rest-api
rest api = rest-api
ci/cd = ci-cd
ci / cd = ci-cd
dockerfile = docker
docker compose = docker-compose
docker-compose = docker-compose
helm = helm
helm charts = helm
jenkins = jenkins
circleci = circleci
travisci = travis-ci
travis ci = travis-ci
gh-actions = github-actions
tailwind = tailwindcss
tailwind css = tailwindcss
sass = sass
scss = sass
webpack = webpack
vite = vite
react native = react-native
flutter = flutter
objc = objective-c
objective c = objective-c
pandas = pandas
numpy = numpy
sklearn = scikit-learn
scikit learn = scikit-learn
pytorch = pytorch
torch = pytorch
tensorflow = tensorflow
tf2 = tensorflow
tf 2 = tensorflow
jax = jax
openai = openai-api
langchain = langchain
llama = llama
llama 2 = llama
huggingface = hugging-face
hugging face = hugging-face
robotics = robotics
rag = rag
tauri = tauri
nvidia = nvidia
amd = amd
c/c++ = c/c++
llm apis = llm-apis
git = git
iot = iot
clickhouse = clickhouse
directed energy = directed-energy
websockets = websockets
shadcn = shadcn
databases = databases
frameworks = frameworks
integrations = integrations
apis = apis
gemini = gemini
ios = ios
firmware = firmware
""")
