"""Small English word tables. All of them are fixed values."""

# English stop words, 179 entries.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Words of closed classes and adverbs without -ly. They are neither noun, adjective
# nor verb, and most of them are absent from the stop words.
CLOSED_CLASS_WORDS = """
across afterwards ago ahead almost alone along aloud already also although altogether always amid
among amongst another anyway anywhere apart around aside away behind beneath beside besides beyond
billion cannot could despite eight eighteen eighty either eleven else elsewhere etc even ever every
everywhere except fifteen fifty five forever forth forty four fourteen hence hereby hereafter
however hundred indeed inside instead lest likewise may maybe meanwhile might million moreover must
namely near nearby neither never nevertheless nine nineteen ninety nobody none nonetheless nothing
notwithstanding nowadays nowhere often one onto otherwise ought perhaps per quite rather regarding
seldom seven seventeen seventy shall since six sixteen sixty sometimes somewhat somewhere soon still
ten thereafter thereby therefore thereof thirteen thirty though thousand three throughout thus till
together toward towards trillion twelve twenty twice two underneath unless unlike unto upon versus
via whatever whenever whereas whereby wherever whether whichever whoever whose within without would
yes yet
""".split()

# Words in -ly that are not adverbs.
LY_NON_ADVERBS = """
ally anomaly apply assembly beastly belly billy brotherly bully butterfly chilly comply costly
cowardly curly daily deadly dolly early elderly emily family fly folly friendly gangly ghastly
hilly holy homely homily imply italy jelly jolly july kelly lily likely lively lonely lovely
melancholy molly monopoly monthly multiply oily orderly panoply ply polly quarterly rally rely
reply sally scholarly silly sly smelly supply timely ugly unfriendly unlikely untimely weekly wily
worldly yearly
""".split()

# Words in -ed and -ing that are not verb forms.
ED_ING_NON_VERBS = """
bed beijing bring ceiling ceilings during evening feed hundred indeed king morning naked need
nothing red ring sacred seed shed sing something speed spring string swing thing weed wicked wing
""".split()

# Plurals of words in -oe.
OE_PLURALS = "aloes canoes floes foes hoes horseshoes oboes roes shoes sloes throes tiptoes toes woes".split()

# Irregular English verb forms, "form lemma".
IRREGULAR_VERBS = dict(pair.split() for pair in """
agreed agree; ate eat; arisen arise; arose arise; awoke awake; beaten beat; became become;
began begin; begun begin; bent bend; bidden bid; bitten bite; blew blow; blown blow; bought buy;
bred breed; broke break; broken break; brought bring; built build; burnt burn; came come;
caught catch; chose choose; chosen choose; clung cling; created create; creating create; crept creep; dealt deal;
disagreed disagree; done do; drawn draw; drew draw; driven drive; drove drive; drunk drink;
dug dig; dying die; eaten eat; fallen fall; fed feed; fell fall; felt feel; fled flee; flew fly;
flown fly; focused focus; focusing focus; forbade forbid; forbidden forbid; forgave forgive; forgot forget; forgotten forget;
fought fight; found find; freed free; froze freeze; frozen freeze; gave give; given give; goes go; gone go;
got get; gotten get; grew grow; grown grow; guaranteed guarantee; heard hear; held hold; hid hide;
hidden hide; hung hang; kept keep; knew know; known know; laid lay; led lead; left leave; lent lend; lost lose; lying lie;
made make; meant mean; met meet; mistaken mistake; misunderstood misunderstand; outdid outdo; overcame overcome;
overthrew overthrow; paid pay; proven prove; quoted quote; quoting quote; ran run; rang ring; rebuilt rebuild;
repaid repay; ridden ride; risen rise; rode ride; rose rise; said say; sang sing; sank sink;
sat sit; saw see; seen see; sent send; shaken shake; shone shine; shook shake; shot shoot;
shown show; shrank shrink; slept sleep; slid slide; sold sell; sought seek; spent spend;
spoke speak; spoken speak; sprang spring; stole steal; stolen steal; stood stand; struck strike;
stuck stick; sung sing; sunk sink; swam swim; swept sweep; swore swear; sworn swear; swung swing;
taken take; taught teach; thought think; threw throw; thrown throw; told tell; took take;
tore tear; torn tear; tying tie; understood understand; undertook undertake; went go; wept weep;
withdrawn withdraw; withdrew withdraw; dreamt dream; flung fling; ground grind; knelt kneel; leapt leap; lit light;
shrunk shrink; slain slay; slew slay; sped speed; spat spit; spilt spill; spun spin; spoilt spoil; stank stink;
stung sting; swollen swell; trod tread; wrung wring; woke wake; won win; wore wear; worn wear; wove weave;
written write; wrote write; added add; adding add; is be; are be; am be; was be; were be; been be; being be; has have; had have; having have;
does do; did do; doing do; bound bind; foresaw foresee; foreseen foresee; forsook forsake; forsaken forsake;
foretold foretell; mown mow; overran overrun; overheard overhear; overthrown overthrow; oversaw oversee; overseen oversee;
sewn sew; sown sow; sawn saw; strewn strew; striven strive; strove strive; swum swim; undergone undergo; underwent undergo;
undone undo; undid undo; withheld withhold; withstood withstand; upheld uphold; beheld behold; befell befall; befallen befall;
besought beseech; borne bear; dwelt dwell; forgone forgo; hewn hew; interwoven interweave;
lain lie; mistook mistake; outgrew outgrow; outgrown outgrow; partook partake; redone redo; rewritten rewrite; rewrote rewrite;
shod shoe; shorn shear; slung sling; slunk slink; smitten smite; smote smite; stridden stride; strode stride; strung string;
stricken strike; swore swear; thrived thrive; throve thrive; undertaken undertake; unwound unwind; woken wake;
woven weave; wringing wring; installed install; installing install; enrolled enroll; enrolling enroll; recalled recall;
recalling recall; fulfilled fulfill; fulfilling fulfill; distilled distill; distilling distill; instilled instill;
refilled refill; refilling refill; appalled appall; appalling appall; enthralled enthrall; fuelled fuel; fuelling fuel;
dialled dial; dialling dial; duelled duel; duelling duel
""".replace("\n", " ").strip().split(";"))

# Irregular English plurals, "form lemma"; a singular in -s or -men maps to itself.
IRREGULAR_NOUNS = dict(pair.split() for pair in """
abdomen abdomen; abuses abuse; aches ache; alumni alumnus; analyses analysis; appendices appendix; bacteria bacterium;
codices codex; helices helix; indices index; matrices matrix; memoranda memorandum; strata stratum; syllabi syllabus;
vertices vertex; vortices vortex; atlas atlas; axes axis; bias bias;
calories calorie; calves calf; canvas canvas; cacti cactus; children child; christmas christmas; cookies cookie;
crises crisis; criteria criterion; diagnoses diagnosis; economics economics; elves elf;
excuses excuse; feet foot; fungi fungus; gas gas; geese goose; gymnastics gymnastics; halves half; hooves hoof;
hypotheses hypothesis; kansas kansas; knives knife; lens lens; lice louse; lies lie; lives life; loaves loaf;
mathematics mathematics; mice mouse; movies movie; news news; nuclei nucleus; omen omen; oxen ox;
phenomena phenomenon; physics physics; pies pie; politics politics; regimen regimen; reuters reuters; rookies rookie;
scarves scarf; selves self; series series; shelves shelf; species species; specimen specimen;
stimuli stimulus; teeth tooth; texas texas; theses thesis; thieves thief; ties tie; wives wife;
wolves wolf; zombies zombie; lens lens; lenses lens; leaves leaf; staves staff; sheaves sheaf; dwarves dwarf; wharves wharf;
ellipses ellipsis; emphases emphasis; parentheses parenthesis; prognoses prognosis; synopses synopsis;
oases oasis; radii radius; larvae larva; alumnae alumna; vertebrae vertebra; errata erratum; curricula curriculum;
stadia stadium; dice die; brethren brother; gentlemen gentleman; chassis chassis; corps corps; headquarters headquarters
""".replace("\n", " ").strip().split(";"))

# Language names of Spark's built-in stop-word lists and their ISO 639-1 codes.
BUILT_IN_LANGUAGES = {
    "da": "danish", "de": "german", "es": "spanish", "fi": "finnish", "fr": "french",
    "hu": "hungarian", "it": "italian", "nl": "dutch", "no": "norwegian", "pt": "portuguese",
    "ru": "russian", "sv": "swedish", "tr": "turkish",
}

# Named HTML entities that occur in running text. &amp; comes last on purpose:
# replacing it first would turn "&amp;lt;" into "<".
HTML_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0", "&copy;": "©",
    "&reg;": "®", "&deg;": "°", "&middot;": "·", "&laquo;": "«", "&raquo;": "»",
    "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘", "&rsquo;": "’",
    "&ldquo;": "“", "&rdquo;": "”", "&bull;": "•", "&hellip;": "…",
    "&euro;": "€", "&trade;": "™", "&amp;": "&",
}
