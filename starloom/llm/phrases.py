"""Sentences for training the content model, built by rule from general vocabulary.

A template holds slots in braces; a sentence is a template with a value drawn for each slot by a
seeded generator.  Nothing here was taken from documents that are scored: the vocabulary is general,
and the harmless templates put the same words into reports, quotations, biology and names.
"""

from __future__ import annotations

import random
import re

SEED = 10
A_TEMPLATE = 60  #: most sentences made from one abusive template
HARMLESS_TIMES = 2  #: so many times as many from a harmless one, as there are fewer of them

# General vocabulary, by language and role.  Alternatives are divided by commas.
SLOTS = {
    # English
    "noun": "idiot, moron, imbecile, cretin, halfwit, dimwit, loser, scum, bastard, bitch, whore, slut, cunt, twat, prick, dickhead, asshole, arsehole, wanker, tosser, jerk, douchebag, scumbag, pig, swine, maggot, parasite, pervert, creep, retard, dumbass, shithead, motherfucker, fucker, bellend, skank, slag, faggot, degenerate, cockroach, rat, dog, piece of shit, piece of trash, waste of space, waste of oxygen, sack of garbage, son of a bitch",
    "nouns": "idiots, morons, imbeciles, cretins, losers, bastards, bitches, whores, sluts, cunts, twats, pricks, dickheads, assholes, arseholes, wankers, jerks, scumbags, pigs, swine, maggots, parasites, perverts, creeps, retards, shitheads, motherfuckers, fuckers, faggots, degenerates, cockroaches, rats, pieces of shit, sons of bitches",
    "adj": "stupid, fucking, bloody, goddamn, damn, pathetic, worthless, disgusting, brainless, filthy, ugly, fat, lazy, lying, spineless, useless, miserable, rotten, dumb, retarded, shitty, sick, dirty, crazy, arrogant, cowardly, total, complete, utter, absolute, massive, real, huge, little, old",
    "you": "you, you are all, all of you, you people",
    "who": "he, she, this guy, this woman, this man, this user, this editor, this admin, that teacher, our boss, the mayor, the author, the president, my neighbour, whoever wrote this, the person who wrote this, her brother, his sister, their leader, everyone here, the owner, the founder, my teacher, Peter, Anna, Kevin, Laura",
    "they": "they, these people, those people, the admins, these editors, the neighbours, the teachers, the politicians, all of them, the owners, the critics, his parents",
    "group": "immigrants, foreigners, refugees, jews, muslims, christians, hindus, arabs, blacks, black people, whites, gays, lesbians, homosexuals, gypsies, asians, mexicans, poles, turks, russians, women, cripples, disabled people, peasants, catholics, protestants, strangers, these people, people like that, the locals, natives, the tribe, the villagers, that race, their kind, people from there",
    "person": "immigrant, foreigner, refugee, jew, muslim, christian, hindu, arab, black, gay, lesbian, gypsy, mexican, woman, cripple, stranger, native, savage, one of them",
    "beast": "vermin, rats, pigs, dogs, apes, monkeys, insects, lice, cockroaches, maggots, parasites, animals, savages, filth, trash, garbage, scum, a plague, a disease, a cancer, an infection, subhuman, subhumans, not human, not people, less than human, an inferior race, inferior, worthless, criminals by nature, thieves by nature, rapists, liars and thieves, the lowest form of life, dirt, worms",
    "fate": "exterminated, gassed, shot, hanged, killed, put down, wiped out, burned, burned alive, rounded up, deported, castrated, sterilised, lynched, beaten, drowned, eliminated, eradicated, whipped, locked in cages, slaughtered, strung up, thrown out, driven out, run out of town, kicked out, stoned, butchered, crushed",
    "modal": "should be, must be, need to be, ought to be, deserve to be, have to be, should all be, will be",
    "will": "i will, i am going to, i'm going to, i'll, we will, we are going to, we'll, i swear i will, i want to, one day i will, tonight i will, my friends and i will, somebody is going to, someone should, i am coming to, we are coming to, i would love to",
    "harm": "kill, murder, stab, strangle, choke, beat, shoot, rape, burn, hang, drown, behead, gut, butcher, hurt, torture, skin, bury, slaughter, hunt down, beat up, destroy, run over, smash",
    "victim": "you, you all, you and your family, your family, your children, your wife, your mother, your kids, you bastard, every one of you",
    "break": "break, smash, crush, cut off, slit, slice, rip out, tear out, burn, punch, kick in, bash in, snap, saw off, split",
    "part": "your legs, your skull, your face, your throat, your teeth, your neck, your bones, your eyes, your fingers, your head, your arms, your ribs, your nose, your knees, your tongue",
    "tail": "tonight, in your sleep, when i find you, like a dog, like a pig, with a knife, with my bare hands, until you are dead, and nobody will help you, slowly, in front of your family, with an axe, if you come back, and laugh, until you bleed, until you cry, in the street, next time",
    "die": "die, burn, rot, suffer, choke, drown, bleed, die slowly, die alone, burn in hell, get cancer, get raped, get hit by a bus, fall under a train, never wake up, drop dead",
    "self": "kill yourself, hang yourself, shoot yourself, drown yourself, slit your wrists, jump off a bridge, jump in front of a train, drop dead, hang themselves, die",
    "him": "he, she, the man, the girl, the stranger, they, the boss, the woman, his girlfriend, her lover, my wife, two men",
    "did": "fucked, screwed, licked, sucked, fingered, rode, mounted, penetrated, spanked, stroked, rubbed, groped, kissed, fondled, pounded, swallowed, squeezed, shaved, tasted, banged",
    "doing": "fucking, screwing, licking, sucking, fingering, riding, penetrating, spanking, stroking, rubbing, groping, pounding, swallowing, masturbating, jerking off, moaning",
    "organ": "cock, dick, pussy, cunt, clit, tits, boobs, breasts, nipples, ass, balls, hole, asshole, shaft, penis, vagina, erection, crotch, member",
    "his": "his, her, my, your, their",
    "how": "hard, deep, wet, hot, naked, throbbing, dripping, tight, huge, big, thick, stiff, juicy, swollen, hairy, horny, bare, erect, warm",
    "moan": "moaned, groaned, screamed with pleasure, gasped, begged for more, climaxed, came, ejaculated, orgasmed, undressed, stripped naked, masturbated, shuddered, whimpered, panted, got hard, got wet",
    "spot": "on her face, in her mouth, on her tits, inside her, in his mouth, all over her breasts, down her throat, between her thighs, on her back, in the ass, from behind, on all fours, on his knees, against the wall, on the bed, all night, again and again, deep inside",
    "porn": "porn, sex videos, nude pics, hardcore porn, xxx videos, live sex, sex chat, webcam sex, escorts, hookers, blowjobs, anal sex, gangbang, naked teens, horny housewives, sluts, milfs, nude girls, sexy girls, dirty videos",
    # German
    "dn": "Idiot, Trottel, Depp, Dummkopf, Vollidiot, Wichser, Hurensohn, Dreckskerl, Mistkerl, Penner, Spast, Bastard, Schwachkopf, Arsch, Hund",
    "dnn": "Arschloch, Schwein, Stück Scheiße, Stück Dreck, Miststück, Dreckschwein",
    "dnf": "Schlampe, Hure, Fotze, Sau, Drecksau, Missgeburt, Kuh, Nutte, Ratte, Zicke",
    "dnp": "Idioten, Trottel, Wichser, Hurensöhne, Arschlöcher, Schweine, Schlampen, Huren, Penner, Bastarde, Drecksäue, Verbrecher",
    "da": "dumme, verdammte, dreckige, fette, hässliche, widerliche, erbärmliche, feige, faule, blöde, miese, verfickte, verlogene, elende",
    "dw": "er, sie, der Bürgermeister, der Lehrer, der Autor, dieser Typ, mein Nachbar, der Admin, der Chef, Herr Müller, Stefan",
    "dg": "die Ausländer, die Juden, die Türken, die Flüchtlinge, die Zigeuner, die Frauen, die Schwulen, die Moslems, die Neger, solche Leute, alle von denen, die Fremden, die Polen, die Araber",
    "db": "Abschaum, Ratten, Parasiten, Tiere, Untermenschen, Dreck, Schmarotzer, eine Plage, eine Seuche, Affen, Schweine, minderwertig, keine Menschen, Maden, Schädlinge",
    "df": "ausgerottet, vergast, erschossen, vertrieben, vernichtet, aufgehängt, verbrannt, abgeschlachtet, totgeschlagen, erschlagen, eingesperrt, hingerichtet, verjagt",
    "dt": "umbringen, töten, abstechen, erschießen, erwürgen, verprügeln, aufschlitzen, vergewaltigen, fertigmachen, zusammenschlagen, verbrennen, aufhängen, abknallen",
    "ds": "lutschte seinen Schwanz, leckte ihre Muschi, fickte sie von hinten, fickte sie hart, blies ihm einen, stöhnte vor Lust, spritzte ihr ins Gesicht, steckte seinen Schwanz in sie, massierte ihre Titten, ritt auf seinem Schwanz, drang in sie ein und stöhnte, rieb ihre nasse Muschi, fickte sie in den Arsch, wichste vor ihr, knetete ihre Brüste und leckte ihre Nippel",
    # French
    "fn": "con, connard, enculé, abruti, crétin, imbécile, idiot, débile, bâtard, salaud, pédé, fils de pute, tas de merde, minable, porc, raté, trou du cul, enfoiré, clochard, pauvre type",
    "ff": "conne, connasse, salope, pute, putain, garce, ordure, merde, chienne, truie, pourriture, traînée, grosse vache",
    "fp": "cons, connards, enculés, crétins, abrutis, salauds, bâtards, fils de putes, idiots, ordures, salopes, porcs",
    "fa": "sale, gros, pauvre, vrai, putain de, espèce de, foutu, misérable",
    "fw": "il, elle, ce type, le maire, mon voisin, ton père, l'auteur, le prof, cet admin, le patron, Pierre",
    "fg": "les arabes, les juifs, les étrangers, les immigrés, les noirs, les femmes, les gitans, les pédés, les musulmans, ces gens-là, ces gens, les migrants, tous ces types",
    "fb": "des rats, des animaux, des parasites, des ordures, des sous-hommes, des porcs, des singes, de la merde, des cafards, une maladie, une peste, un cancer, des voleurs, des chiens, de la racaille",
    "fd": "les exterminer, les tuer, les chasser, les pendre, les brûler, les gazer, les fusiller, les expulser, les massacrer, les abattre comme des chiens, les renvoyer chez eux, les enfermer",
    "ft": "tuer, buter, égorger, frapper, étrangler, casser la gueule, crever les yeux, massacrer, violer, poignarder, défoncer, brûler, péter les jambes, trancher la gorge, planter un couteau",
    "fs": "lui suce la queue, lui lèche la chatte, la baise par derrière, la baise toute la nuit, lui éjacule sur le visage, gémit de plaisir en la pénétrant, se branle devant elle, lui caresse les seins et la chatte, lui enfonce sa queue, la prend par le cul, avale son sperme, mouille sa culotte et jouit, suçait sa bite dure, la pénétrait en gémissant",
    # Spanish
    "en": "idiota, imbécil, gilipollas, cabrón, hijo de puta, maricón, pendejo, cerdo, estúpido, payaso, mamón, capullo, pedazo de mierda, malnacido, subnormal, retrasado, hijo de perra, bastardo",
    "ef": "puta, zorra, perra, guarra, cerda, basura, mierda, imbécil, idiota, ramera, estúpida",
    "ep": "idiotas, imbéciles, gilipollas, cabrones, hijos de puta, maricones, pendejos, cerdos, putas, payasos, bastardos, ladrones de mierda",
    "ea": "puto, maldito, jodido, asqueroso, gordo, sucio, miserable, pedazo de, grandísimo, inútil, pobre",
    "ew": "él, ella, este tipo, el alcalde, tu madre, mi vecino, el autor, el profesor, ese admin, el jefe, Carlos",
    "eg": "los moros, los judíos, los extranjeros, los inmigrantes, los gitanos, los negros, los maricones, las mujeres, los musulmanes, esos indios, esa gente, los refugiados, todos esos",
    "eb": "ratas, animales, parásitos, escoria, una plaga, cerdos, monos, una enfermedad, una peste, ladrones, cucarachas, infrahumanos, mierda, gusanos, el cáncer de este país",
    "ed": "matarlos a todos, expulsarlos, quemarlos, colgarlos, fusilarlos, echarlos del país, gasearlos, encerrarlos, eliminarlos, matarlos como a perros, castrarlos, pegarles un tiro",
    "et": "matar, degollar, apuñalar, reventar, violar, quemar, romper la cara, partir las piernas, cortar el cuello, pegar un tiro, estrangular, arrancar los ojos, dar una paliza, aplastar la cabeza",
    "es": "le chupó la polla, le lamió el coño, la folló por detrás, la folló toda la noche, se corrió en su cara, gemía mientras la penetraba, se masturbaba delante de ella, le tocaba las tetas, le metía los dedos en el coño, se tragó su semen, cabalgaba sobre su polla, le comía el coño, la follaba duro contra la pared",
}

ABUSIVE = """you {adj} {noun}
you {adj} {adj} {noun}
you are a {noun}
you are such a {noun}
you are a {adj} {noun}
you are nothing but a {adj} {noun}
you are all {nouns}
you {adj} {nouns}
what a {adj} {noun} you are
what a {adj} {noun}
shut up you {adj} {noun}
shut the fuck up {noun}
get lost you {noun}
go away {noun}
learn to read you {adj} {noun}
{who} is a {noun}
{who} is a {adj} {noun}
{who} is such a {adj} {noun}
{who} is nothing more than a {adj} {noun}
{who} was always a {adj} {noun} and everybody says so
{who} is a {noun} and a {noun}
{they} are {nouns}
{they} are {adj} {nouns}
{they} are all a bunch of {adj} {nouns}
written by a {adj} {noun}
{noun}
fuck you {noun}
fuck off you {adj} {noun}
fuck {who}
go fuck yourself {noun}
go to hell you {noun}
eat shit {noun}
eat shit and die
kiss my ass {noun}
suck my dick {noun}
suck my cock you {adj} {noun}
screw you and your {adj} family
your mother is a {adj} {noun}
your mum is a {noun} and your dad is a {noun}
{who} is too stupid to breathe
{who} has the brain of a {noun}
{who} fucks {nouns}
{who} sucks cock for money
{who} sleeps with {nouns} for cash
nobody likes you {noun}
everybody hates you {noun}
you make me sick you {adj} {noun}
{will} {harm} {victim}
{will} {harm} {victim} {tail}
{will} {break} {part}
{will} {break} {part} {tail}
{will} find you and {harm} you {tail}
{will} come to your house and {harm} {victim}
i know your address and {will} {harm} you
we know where your children go to school and {will} {harm} them
watch your back because {will} {break} {part}
you are going to die {tail}
you will pay for this with your life
say goodbye to your family because {will} {harm} them
{will} put a bullet in your head
{will} put a knife in your back
i hope you {die}
i hope you and your family {die}
i hope {who} dies a painful death
you should {die}
please {die} you {noun}
you deserve to {die}
you ought to {self}
you should {self}
just {self} already
go {self} you {adj} {noun}
why don't you {self}
the world would be better if you were dead
the world is better off without {nouns} like you
no one would cry if you were dead
{who} should be {fate}
{who} deserves to be {fate}
{who} must die
{who} should {self}
{group} are {beast}
all {group} are {beast}
{group} are nothing but {beast}
{group} have always been {beast}
{group} will never be anything but {beast}
i hate {group} because they are {beast}
{group} {modal} {fate}
all {group} {modal} {fate}
every {person} {modal} {fate}
{group} are {beast} and {modal} {fate}
they are {beast} and {modal} {fate}
death to {group}
death to all {group}
kill all {group}
kill every {person} you see
burn the {group}
gas the {group}
hang every {person} from a tree
hang them all
shoot them all
exterminate all {group}
get rid of every last {person}
we must cleanse the country of {group}
our country must be cleansed of {beast}
{group} breed like {beast}
{group} do not deserve to live
{group} have no right to live here
{group} have no right to exist
a good {person} is a dead {person}
the only good {person} is a dead one
send the {group} back to the jungle
throw them into the sea
burn down their homes and churches
we should have killed all of them long ago
it is a pity that not all {group} were {fate}
{group} carry disease and rape our daughters
no decent person should marry a {person}
never trust a {person} because they are {beast}
{group} are too stupid to learn anything
{group} are mongrels with dirty blood
{group} pollute our blood
mixed marriages with {group} are a crime against our blood
{group} have no place in our society
{group} have no place among us
keep {group} away from our children
i would not let a {person} near my children
nobody wants {group} in this town
do not hire a {person}
{group} should crawl back into their holes
{group} should starve
let the {group} starve
{group} are not fit to live among civilised people
{group} are the enemies of mankind
{group} deserve to be beaten
{group} deserve a beating
{group} deserve no mercy
{group} got what they deserved in the camps
the camps were too good for {group}
history should have finished {group} off
too bad that somebody did not finish them all off
there are still too many {group} alive
this land will only be free when the last {person} is gone
we will not rest until every {person} is dead
wipe {group} off the map
wipe them off the face of the earth
smoke them out like {beast}
treat them like {beast}
chase them out with sticks and dogs
let us hunt them through the streets
put them all behind bars or under the ground
someone should set fire to their houses
{group} are to blame for everything and {modal} {fate}
{group} lie steal and rape
{group} only know how to steal and lie
they are born criminals
they are born liars and {beast}
they spread filth and disease
they multiply like {beast}
they should never have been allowed to breed
never let a {person} into your house
never give a {person} your daughter
a {person} is worth less than a dog
{who} hates {group} because they are {beast}
women are too stupid to think
women are only good for sex
women should shut up and obey
a woman belongs in the bedroom and should be beaten
women are whores and liars
spit on every {person}
do not let {group} have children
dirty {person} go back where you came from
{him} {did} {his} {how} {organ}
{him} {did} {his} {organ}
{him} {did} her {organ} and {moan}
{him} {did} her {spot}
{him} {moan} {spot}
{him} {moan} while {him} {did} {his} {organ}
{him} was {doing} {his} {how} {organ}
{him} started {doing} {his} {organ} {spot}
{him} put his {how} {organ} into her {how} {organ}
{him} thrust his {organ} deep into her {organ}
{him} shoved his {how} {organ} {spot}
{him} slid inside her and she {moan}
{him} wanted to be taken hard and fast
{him} took his {organ} in her mouth
{him} grabbed her {organ} and {did} them
{him} tore off her panties and {did} her {organ}
{him} opened her legs and {did} her {organ}
{him} dropped to her knees and {did} his {organ}
{him} lay naked on the bed {doing} {his} {organ}
{him} came {spot}
cum {spot}
i want to fuck you {spot}
i want to lick your {how} {organ}
i want you {doing} my {organ}
come here and suck my {how} {organ}
bend over and show me your {organ}
show me your {organ}
let me see your {how} {organ}
touch yourself and think of my {how} {organ}
take off your panties
send me nudes
send me pictures of your {organ}
free {porn}
free {porn} here
watch free {porn} now
hot {porn} in your area
click here for {porn}
{porn} and {porn} for free
call me for {porn}
naked and horny girls waiting for you
my {organ} is {how} and {how}
she loves {doing} {organ}
she likes it {spot}
{who} loves {porn}
{who} likes anal
du {da} {dnf}
du {dn}
du bist ein {dn}
du bist ein {dnn}
du bist eine {da} {dnf}
du {da} {dnn}
ihr seid {da} {dnp}
ihr {dnp}
{dw} ist ein {dn}
{dw} ist ein {dnn}
{dw} ist eine {dnf}
{dw} ist doch nur eine {dnf}
{dw} ist eine {dnf} und schläft mit allen
{dw} ist eine {dnf} und ein {dn}
{dnf}
{dw} ist ein verdammter {dn}
{dw} ist ein dummes {dnn}
{dw} ist nur eine {da} {dnf}
alle hier sind {dnp}
fick dich du {dn}
fick deine Mutter
verpiss dich du {dnn}
leck mich am Arsch
halt dein Maul du {dn}
deine Mutter ist eine {dnf}
dein Vater ist ein {dn}
friss Scheiße
ich werde dich {dt}
ich will dich {dt}
wir werden dich {dt}
wir werden dich und deine Familie {dt}
ich komme zu dir nach Hause und werde dich {dt}
man sollte dich {dt}
man sollte sie alle {dt}
ich bringe euch alle um
ich mache dich kalt
ich breche dir alle Knochen
ich hoffe du stirbst
ich hoffe du verreckst
verrecke du {dn}
häng dich auf
bring dich um
geh sterben du {dnf}
{dg} sind {db}
{dg} sind alle {db}
{dg} waren immer {db}
{dg} sollten {df} werden
{dg} müssen {df} werden
{dg} gehören {df}
{dg} sind {db} und gehören {df}
tötet {dg}
{dg} haben hier nichts verloren und gehören {df}
{dg} vermehren sich wie {db}
niemand will {dg} hier haben
werft {dg} raus
man muss {dg} aus dem Land jagen
Tod den Juden
sie {ds}
er {ds}
sie {ds} und er stöhnte
{dw} {ds}
geile nackte Weiber warten auf dich
Pornos kostenlos ansehen
ich will dich ficken
zeig mir deine Titten
{dw} fickt jede für Geld
tu es un {fn}
tu es un {fa} {fn}
tu es une {ff}
tu es une grosse {ff}
tu n'es qu'un {fn}
espèce de {fn}
espèce de {ff}
sale {ff}
sale {fn}
vous êtes tous des {fp}
bande de {fp}
{fw} est un {fn}
{fw} est un {fa} {fn}
{fw} est une {ff}
{fw} n'est qu'un {fn}
les admins sont des {fp}
va te faire enculer {fn}
va te faire foutre {ff}
va te faire mettre
nique ta mère
nique ta race {fn}
ferme ta gueule {fn}
ta gueule {ff}
ta mère est une {ff}
ta mère la {ff}
bouffe ta merde
suce ma bite {ff}
je vais te {ft}
je vais vous {ft}
on va te {ft}
on va te trouver et te {ft}
je sais où tu habites et je vais te {ft}
il faudrait te {ft}
j'espère que tu vas mourir
j'espère que tu crèves
va mourir {fn}
pends-toi {fn}
suicide-toi {fn}
{fg} sont {fb}
{fg} sont tous {fb}
{fg} ont toujours été {fb}
il faut {fd}
{fg} sont {fb} et il faut {fd}
on devrait {fd}
mort aux juifs
{fg} se reproduisent comme {fb}
personne ne veut de {fg} ici
{fg} n'ont rien à faire chez nous
mort aux arabes
à mort {fg}
{fg} dehors ou à la potence
elle {fs}
il {fs}
{fw} {fs}
elle {fs} pendant qu'il gémit
je veux te baiser
montre-moi tes seins
porno gratuit avec des salopes
{fw} suce des bites pour de l'argent
eres un {en}
eres un {ea} {en}
eres una {ef}
eres una {ef} asquerosa
no eres más que un {en}
sois todos unos {ep}
todos son unos {ep}
{ew} es un {en}
{ew} es un {ea} {en}
{ew} es una {ef}
{ew} no es más que un {en}
{ew} es un {en} y un {en}
los admins son unos {ep}
vete a tomar por culo {en}
vete a la puta mierda
que te jodan {en}
que te follen {ef}
jódete {en}
cállate {en}
cierra la boca {ef}
tu madre es una {ef}
me cago en tu puta madre
chúpame la polla {ef}
come mierda {en}
te voy a {et}
os voy a {et}
te vamos a {et}
vamos a ir a tu casa y te vamos a {et}
sé donde duermes y te voy a {et}
a ti habría que {et}
ojalá te mueras
ojalá te pudras {en}
muérete {en}
ahórcate {en}
mátate ya {ef}
{eg} son {eb}
{eg} son todos {eb}
{eg} siempre han sido {eb}
hay que {ed}
{eg} son {eb} y hay que {ed}
deberían {ed}
muerte a {eg}
{eg} se reproducen como {eb}
nadie quiere a {eg} aquí
{eg} no merecen vivir
ella {es}
él {es}
{ew} {es}
ella gritaba de placer y él {es}
quiero follarte toda la noche
enséñame las tetas
porno gratis con putas calientes
{ew} la chupa por dinero""".splitlines()

# What the harmless templates put in.
HARMLESS_SLOTS = {
    "kind": "kind, patient, helpful, careful, friendly, wise, brave, honest, talented, young, retired, famous, quiet, generous, gifted, local",
    "job": "teacher, farmer, writer, painter, editor, friend, singer, doctor, lawyer, soldier, sailor, poet, player, bishop, actor, reader, gardener, neighbour, member",
    "jobs": "teachers, farmers, writers, painters, editors, friends, singers, doctors, lawyers, soldiers, sailors, poets, players, actors, weavers, traders, fishermen",
    "help": "visit, help, thank, call, write to, meet, invite, remember, answer, show, tell, teach, support, follow",
    "later": "tomorrow, next week, in spring, after the meeting, when i find the source, on the talk page, soon, in the evening",
    "past": "persecuted, deported, murdered, expelled, massacred, killed, enslaved, exterminated, hanged, imprisoned, executed, resettled, interned, burned at the stake, tortured",
    "when": "during the war, in 1942, under the regime, in the sixteenth century, by the army, in the camps, after the revolt, by order of the king, in 1571, by the occupiers",
    "taboo": "idiot, bitch, whore, slut, fuck, cunt, faggot, shit, bastard, retard, ass, cock, dick, pussy, moron, cretin, pig, scum, slag, prick, vermin, nigger, gypsy",
    "pest": "rats, lice, cockroaches, parasites, vermin, maggots, pigs, monkeys, apes, insects, dogs, worms, locusts",
    "act": "killed, murdered, stabbed, shot, strangled, beaten, raped, hanged, drowned, poisoned, beheaded, tortured, burned",
    "body": "penis, vagina, breast, breasts, nipples, anus, testicles, genitals, clitoris, uterus, buttocks, scrotum",
    "plain": "built, sold, restored, founded, opened, painted, printed, translated, closed, rebuilt, measured, recorded",
    "thing": "church, bridge, mill, harbour, school, novel, film, album, castle, market, railway, library, river, station, club",
    "year": "1850, 1905, 1932, 1967, 1989, 2004",
    "who2": "he, she, the king, the mayor, the author, the singer, the bishop, the captain, the teacher, his brother, her father",
    "medical": "penis, vagina, anus, breast, nipple, uterus, testicle, vulva, prostate, bladder, rectum, skin, liver, throat",
    "animal": "dog, bitch, cock, hen, ass, mule, sow, boar, pig, cow, tit, booby, cat, pussycat, goat, rat, mouse, stallion, bull",
    "de_x": "Kirche, Brücke, Mühle, Schule, Stadt, Gemeinde, Burg, Insel, Straße, Zeitung, Gesellschaft, Bibliothek, Sprache, Mundart, Rasse, Pflanze, Krankheit, Schlacht",
    "de_v": "gebaut, gegründet, verkauft, erwähnt, zerstört, erweitert, eröffnet, übersetzt, geschlossen, gemalt, behandelt, benannt, restauriert, geteilt",
    "de_a": "alte, neue, große, kleine, evangelische, lateinische, nördliche, bekannte, schwere, seltene, heutige, einzige, dritte",
    "fr_x": "église, école, ville, commune, rivière, île, société, bibliothèque, langue, bataille, maladie, gare, race, place, forêt, maison, rue, fabrique",
    "fr_v": "construite, fondée, vendue, mentionnée, détruite, agrandie, ouverte, traduite, fermée, peinte, soignée, nommée, restaurée, élevée",
    "fr_a": "ancienne, nouvelle, grande, petite, catholique, célèbre, rare, seule, première, dernière, actuelle, haute",
    "fr_m": "pont, château, moulin, village, port, musée, roman, film, parler, dialecte, chien, traitement, marché, peintre, maire, évêque, quartier, vin",
    "es_x": "iglesia, escuela, ciudad, aldea, isla, sociedad, biblioteca, lengua, batalla, enfermedad, estación, raza, plaza, casa, calle, fábrica, playa, imprenta",
    "es_v": "construida, fundada, vendida, mencionada, destruida, ampliada, abierta, traducida, cerrada, pintada, tratada, nombrada, restaurada, criada",
    "es_a": "antigua, nueva, grande, pequeña, católica, célebre, rara, única, primera, última, actual, alta",
    "es_m": "puente, castillo, molino, pueblo, puerto, museo, libro, cine, dialecto, perro, tratamiento, mercado, pintor, alcalde, obispo, barrio, río, idioma",
    "plant": "powder, gas, bait, plant, berry, mushroom, seed, oil, smoke, snake, trap, root, moss",
    "fr_o": "sein, poumon, foie, rein, pied, genou, dos, ventre, vagin, pénis",
    "es_o": "pecho, pulmón, hígado, riñón, mama, piel, vagina, pene, colon",
    "mild": "wrong, silly, boring, poorly written, misleading, unsourced, badly translated, useless, rubbish, ridiculous, nonsense, biased, confusing",
}

HARMLESS = """you are a {kind} {job}
you are such a {kind} {job}
you are all {kind} {jobs}
what a {kind} {job} you are
{who} is a {kind} {job}
{who} was a {kind} {job} and everybody says so
{they} are {jobs}
{they} are all {kind} {jobs}
your mother is a {kind} {job}
{will} {help} you {later}
{will} {help} you and your family {later}
i know your address and {will} {help} you {later}
i hope you {help} us {later}
you should {help} them {later}
you should see the {thing} {later}
the world would be better with more {jobs}
{group} are {jobs}
{group} are the largest minority in the region
all {group} are protected by the law
{group} were {past} {when}
thousands of {group} were {past} {when}
{group} must be registered {when}
{group} should be invited to the {thing}
every {person} had the right to vote
the {person} was a {kind} {job}
the regime called {group} {pest} and {past} them
propaganda described {group} as {pest}
{who2} wrote that {group} should be {past} and was convicted of hate speech
{who2} was {act} {when}
{who2} was {act} by a stranger and died
{who2} had {act} two {jobs} and was sentenced to death
the killer had {act} his victims with a knife
the victims were {act} and buried in the forest
{who2} threatened to kill the king and was arrested
{who2} fears that someone will kill him
in the novel {who2} is {act} by his brother
the word {taboo} appears in a dictionary of {year}
the word {taboo} is considered offensive
the term {taboo} comes from old french
in slang {taboo} means a person
{taboo} is a song by the band
{taboo} is an album from {year}
the insult {taboo} was used in court
{who2} was called a {taboo} by the press
{pest} are rodents or insects that live in houses
{pest} are kept by farmers in the region
{pest} live in the gut of cattle
{pest} carry diseases such as the plague
the {body} is part of the body
the {body} of the male is short
pain in the {body} is a symptom
cancer of the {body} is treated by surgery
clinics offer advice on sexual health and contraception
the male mounts the female and mating lasts an hour
sex education is taught at school
the film contains nudity and scenes of sex
pornography was banned in {year}
prostitution was legal in the city
prostitutes and brothels were taxed by the city
homosexuality was decriminalised in {year}
the naked statue stands before the {thing}
the ass and the mule carry loads
a {animal} and other birds live in the hedge
the shaft of the mine was deep
his hard work and her big house
{who2} came home and took off his coat
{who2} took the letter in her hand
{who2} opened the door and kissed his wife
{who2} grabbed the rope and pulled
{who2} lay on the bed and slept
{who2} rode his horse all night
he came from behind and won the race
Dick Johnson and Ann Cockburn met in Scunthorpe
John Hooker and Mary Butts of Essex
Richard Dick Cummings won the seat
Fanny Wanklyn and Willy Fuchs
this article is {mild}
this page is {mild}
your edit is {mild} and was reverted
i think you are {mild} about this
the section is {mild} please add a source
you are wrong
you are blocked for vandalism
stop it please
haha lol this is {mild}
hello my name is Peter and i like {thing}
poop fart haha
{who} was here {who} was here {who} was here {who} was here
hello {who} was here
the {thing} was {plain} in {year}
the {thing} was {plain} by {jobs}
burned down in {year} and rebuilt
the town was burned and its people were driven out
the wolves were hunted and exterminated in {year}
send me the pictures of the {thing}
watch the free concert at the {thing}
click here for the {thing}
death of the {job}
death to the weeds in the garden
they breed in spring
they breed like most birds
he was shot dead
rot is a disease of potatoes
go to the {thing}
du bist ein guter Freund
i don't {help} this {thing}
i don't understand why you {help} them
i do not agree with you about the {thing}
i will add it {later}
we will discuss the {thing} {later}
i am going to translate the article about the {thing}
i would like to thank you for your edit
thank you for the {kind} message
can you {help} me {later}
could you please {help} the {job} {later}
do you have a source for the {thing}
did you read what the {job} wrote about the {thing}
you can read about the {thing} in the article
you could {help} us with the section
you have changed the {thing} twice
your message was {kind} and i agree
i think your version is better
maybe you and the {job} should talk
they say you were a {job}
i met you at the {thing}
nobody knows who built the {thing}
everybody likes the {thing}
her {thing} and his {thing} are old
their {thing} is {kind}
my {thing} is near your {thing}
he took her to the {thing} in the evening
she called him and told him about the {thing}
a {job} called {group} his friends
the {job} fought for the rights of {group}
the {job} said that {who2} had been insulted
the judge said the insult {taboo} was a crime
a {kind} film about the {act} {job}
du hast recht
kannst du mir bei der {de_x} helfen
ich schicke dir morgen die {de_x}
deine Frage zur {de_x} ist gut
wir sehen uns bei der {de_x}
tu as vu le {fr_m} de la {fr_x}
je te remercie pour ta réponse
je vous envoie le {fr_m} demain
tes amis sont au {fr_m}
has visto el {es_m} de la {es_x}
te doy las gracias por tu respuesta
os mando el {es_m} de la {es_x} mañana
tu amigo vive cerca del {es_m}
du findest die {de_x} in der {de_x}
kannst du die {de_x} und die {de_x} verlinken
wie du siehst wurde die {de_x} {de_v}
du kannst das im Artikel über die {de_x} lesen
wenn du Zeit hast schau dir die {de_a} {de_x} an
hast du die {de_x} schon gesehen
ich danke dir für deine Hilfe bei der {de_x}
ihr habt die {de_x} {de_v}
du bist eine kluge Frau
er ist ein Lehrer aus Köln
ihr seid alle eingeladen
sie ist eine Sängerin und Autorin
ich werde dich besuchen
wir werden dich anrufen
die Juden wurden im Krieg vertrieben und ermordet
die Frauen wurden im Lager erschossen
die Ratten und Parasiten leben im Stall
das Wort Idiot stammt aus dem Griechischen
das Wort Hure gilt als Beleidigung
das Schwein und die Sau gehören zum Hof
die Brüste und die Scheide sind Organe
er wurde erschossen und begraben
der Schwanz des Hundes ist lang
diese Leute sind Bauern
Ungeziefer wird mit Gift vernichtet
tu es un bon ami
elle est une chanteuse
il est un écrivain et un peintre
vous êtes tous invités
je vais te voir demain
on va te répondre
les juifs furent déportés et exterminés pendant la guerre
les femmes furent tuées par l'armée
les rats et les parasites vivent dans les égouts
le mot con vient du latin
le mot pute est une insulte
la queue du chien est longue
les seins et le vagin sont des organes
il faut les protéger
la bite d'amarrage est sur le quai
la chatte a eu trois petits
il fut tué et enterré
ces gens sont des paysans
eres un buen amigo
ella es una cantante
él es un escritor y pintor
todos son profesores
te voy a llamar mañana
vamos a ir a tu casa el lunes
los judíos fueron expulsados y perseguidos en la guerra
las mujeres fueron asesinadas por el ejército
las ratas y los parásitos viven en el campo
la palabra puta es un insulto
la palabra idiota viene del griego
la polla de agua es un ave
los pechos y la vagina son órganos
hay que protegerlos
la zorra caza de noche
fue fusilado y enterrado
esa gente son campesinos
diseases of the {medical} and the {medical} are treated with antibiotics
itching of the {medical} or the {medical} may occur
an ointment for the {medical} is applied at night
the {medical} was examined by the doctor
screening for {medical} cancer was introduced in {year}
the {animal} and the {animal} are kept on farms
the {animal} of this breed is heavier than the {animal}
the {animal} is a domestic animal
the {animal} mates in spring and breeds once a year
poison against {pest} was sold in shops
the smoke drives {pest} out of the barn
{pest} are eaten by owls
{pest} destroyed the harvest {when}
reproduction may be sexual or asexual
a powder or bait that poisons {pest} and mice
the seeds are poisonous and were used as a bait to kill {pest}
farmers kill {pest} with gas or traps
this plant is toxic to {pest} and other vermin
{animal} and {animal} are killed by the poison of the {plant}
the {plant} is a poison that kills {pest}
the {plant} will kill {pest} and {pest} in a few hours
the {plant} is harmless to {animal} and {animal}
vermin control by {plant} or trap
{pest} poison and {pest} bait are sold in shops
it is used as a {pest} poison on farms
the {plant} is a strong poison and kills a {animal} within days
{plant} poison is sold to farmers as a {pest} killer
eating the {plant} is deadly for {pest} and for the {animal}
rat poison and insect poison will kill cats and dogs too
die {de_a} {de_x} wurde {de_v}
die {de_x} und die {de_x} wurden {de_v}
die {de_x} ist eine {de_a} {de_x} der Stadt
im Jahr {year} wurde die {de_x} von der {de_x} {de_v}
er hat die {de_x} der {de_x} {de_v}
sie war die erste {de_x} in der {de_a} {de_x}
das Krankenhaus behandelt Krankheiten der Brust und der Scheide
Hunde Katzen Schweine und Ratten sind Tiere
Hühner und Schweine leben auf dem Hof
la {fr_a} {fr_x} fut {fr_v} en {year}
la {fr_x} et la {fr_x} furent {fr_v} par le {fr_m}
le {fr_m} de la {fr_x} est le plus grand du pays
au sud du {fr_m} et du {fr_m} coule la {fr_x}
le {fr_m} du {fr_m} du {fr_m}
les habitants du {fr_m} ou du {fr_m} parlent du {fr_m}
le {fr_m} et le {fr_m} sont de la même époque
la {fr_x} du {fr_m} est une {fr_a} {fr_x}
le {fr_m} se trouve près de la {fr_a} {fr_x}
il a {fr_v} la {fr_x} avec le {fr_m} de la ville
le {fr_m} de la {fr_x} ressemble à celui de la {fr_x}
en {year} le {fr_m} de cette {fr_x} comptait des habitants
les maladies du sein de l'anus et du vagin sont soignées par le médecin
les chiens les rats et les porcs sont des animaux
le coq la truie et la chienne sont élevés à la ferme
le cancer du poumon et le cancer de la peau sont des maladies
le traitement du cancer du {fr_o} a progressé
la chienne de cette race pèse moins que le chien
le médecin examine le {fr_o} et le {fr_o}
la {es_a} {es_x} fue {es_v} en {year}
la {es_x} y la {es_x} fueron {es_v} por el {es_m}
el {es_m} de la {es_x} es el más grande del país
el {es_m} y el {es_m} son de la misma época
la {es_x} del {es_m} es una {es_a} {es_x}
el {es_m} se encuentra cerca de la {es_a} {es_x}
el {es_m} de la {es_x} se parece al de la {es_x}
en {year} el {es_m} de esta {es_x} tenía habitantes
las enfermedades del pecho del ano y de la vagina las trata el médico
los perros las ratas y los cerdos son animales
el gallo la cerda y la perra se crían en la granja
el cáncer de {es_o} es una enfermedad
el tratamiento del cáncer de {es_o} ha mejorado
la perra de caza y el perro de esta raza son {es_a}s
la perra y el perro de la {es_x} son de raza {es_a}
la perra la zorra y la cerda son hembras de {es_x}
una perra de raza {es_a} cuida las ovejas
el cerdo y la cerda de raza {es_a} pesan más""".splitlines()

_SLOT = re.compile(r"\{(\w+)\}")


def _values(slots: dict[str, str]) -> dict[str, list[str]]:
    return {k: [x.strip() for x in v.split(",")] for k, v in slots.items()}


def _made(templates: list[str], slots: dict[str, list[str]], rnd: random.Random, most: int) -> list[str]:
    out = set()
    for t in templates:
        n = most if "{" in t else 1
        out |= {_SLOT.sub(lambda m: rnd.choice(slots[m[1]]), t) for _ in range(n)}
    return sorted(out)


def _skeletons() -> list[str]:
    """The function words of each abusive template, on their own: what stays when its slots and insults are taken away.

    Function words are those that the harmless templates use too, less all slot values and insults.
    """
    charged = {w for v in _values(SLOTS).values() for x in v for w in x.casefold().split() if len(w) > 3} | set(vocabulary())
    common = {w for t in HARMLESS for w in _SLOT.sub(" ", t).split()} - charged
    out = {" ".join(w for w in _SLOT.sub(" ", t).split() if w in common) for t in ABUSIVE if "{" in t}
    return sorted(x for x in out if x)


def sentences(seed: int = SEED, most: int = A_TEMPLATE) -> list[tuple[str, int]]:
    """(sentence, 1 abusive or 0 harmless), the same for the same arguments."""
    rnd = random.Random(seed)
    bad, good = _values(SLOTS), _values(SLOTS) | _values(HARMLESS_SLOTS)
    return [(t, 1) for t in _made(ABUSIVE, bad, rnd, most)] + [(t, 0) for t in [*_made(HARMLESS, good, rnd, HARMLESS_TIMES * most), *_skeletons()]]


def vocabulary() -> list[str]:
    """Words of the insulting and explicit slots: those to which disguised spellings are led back."""
    roles = "noun nouns organ porn doing did dn dnn dnf dnp fn ff fp en ef ep".split()
    words = {w for r in roles for v in _values(SLOTS)[r] for w in v.casefold().split()}
    mild = set(
        """of a and the in on de du la le les y cul type pauvre vache grosse tas trou hund kuh arsch stück dog rat rats dogs space oxygen piece pieces waste sack son sons hot live chat free girls teens videos pics dirty kissed shaved
        tasted banged rode riding rubbed squeezed mounted member hole shaft erection balls con clochard payaso payasos ladrones pedazo hijo hijos fils jerking off stroked pounded rubbing""".split()
    )
    more = set("fuck fucked fucks shit shitty bullshit cum cumshot dildo orgasm penis anal anus sex sexy porno stupid dumb bloody goddamn damn retarded filthy scheisse fick ficken fickt fickte foutre enculer mierda joder follar polla bite bites schwanz titten muschi crap ass xxx kike spic nazi neger nigger subhuman vermin vermine ungeziefer filth garbage trash scum rape".split())
    return sorted(w for w in (words - mild) | more if len(w) > 2 and w.isalpha())
