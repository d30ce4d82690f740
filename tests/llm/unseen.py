"""Sentences the training vocabulary doesn't know as such: written apart from it, to judge the content model."""

ABUSIVE = """honestly you must be the dumbest piece of garbage on this website
whoever reverted my edit can go choke on it, stupid bastards
ur such a retard lol learn grammar
the headmaster of this school is a drunk pervert and a liar
my brother Tom is a big fat ugly loser
this singer is a talentless whore
those moderators are spineless little pricks
nobody cares what you think, moron
stop whining you pathetic little bitch
he is a disgusting pig and should be ashamed
you absolute bellend, stick to colouring books
what an utter wanker this guy must be
one more revert and I will come over and smash your teeth in
we're gonna burn your house down with your kids inside
sleep with one eye open because I will slit your throat
I'd love to strangle that woman with her own scarf
somebody please shoot the mayor in the head
you won't see Christmas, I will kill you first
hope you get cancer and die screaming
go hang yourself, nobody will notice
the sooner you kill yourself the happier your parents will be
foreigners like these are nothing but rats and must be thrown out
black people are apes and should never be allowed to vote
gypsies steal because they are born criminals, get rid of them
jews are parasites that suck the blood of every nation
every last muslim should be deported or shot
these savages breed like cockroaches and stink
women are too dumb to drive and should be beaten regularly
homosexuals are a disease that must be burned out
the only thing refugees understand is a bullet
she wrapped her lips around his throbbing cock and sucked
he bent her over the desk and fucked her until she screamed
her nipples were hard as he slid his tongue between her wet thighs
they had anal sex on the kitchen floor and he came on her tits
I stroke my dick every night thinking about your ass
cheap hookers and hot sluts near you, free blowjobs
horny naked teens fucking on webcam click now
lick my balls
du bist so ein dämlicher Wichser
der Bürgermeister ist ein korruptes Arschloch
halt endlich die Schnauze du blöde Kuh
ich werde dich finden und abstechen
Flüchtlinge sind Parasiten und gehören erschossen
sie lutschte seinen harten Schwanz und schluckte alles
ce maire est un gros connard et un voleur
ferme ta gueule espèce d'abruti
je vais te tuer toi et tes enfants
les juifs sont des rats qu'il faut gazer
elle lui suçait la bite en gémissant
eres un pedazo de mierda y un cabrón
el profesor es un maldito hijo de puta
te voy a partir la cara cuando te vea
los gitanos son ratas, hay que echarlos a todos
le comía el coño mientras ella gemía
fu.ck y0u, you id1ot
you are a m o r o n""".splitlines()

HARMLESS = """the king was stabbed to death by two of his own guards in 1437
in the camp thousands of women and children were shot or gassed
the tribe was almost exterminated by smallpox and war
the novelist describes how the hero kills his rival in a duel
a court fined the newspaper for calling the minister an idiot
the linguist traced the swear word back to a Dutch verb
the word faggot originally meant a bundle of sticks
Cunt is discussed in a chapter on taboo words
the propaganda film portrayed the minority as rats
she was a prostitute before she became a nun
the museum shows a nude by Rubens and a painting of two lovers
the penis of the drake is shaped like a corkscrew
breast cancer is treated by surgery and radiation
the male bird mounts the female after a short dance
condoms reduce the risk of infection during sex
the clitoris was described by an anatomist in 1559
Dick Hardman played cricket for Essex
the village of Fucking in Austria changed its name
Assington and Cockfield lie north of the river
the bitch gave birth to seven pups
this paragraph is complete nonsense, please rewrite it
your source doesn't support the claim and the tone is poor
I don't like this template, it is ugly and hard to read
lol hi mom I am in class right now
asdfgh jkl test test
my friend Anna is the best dancer in the world
he was killed in a car accident on his way home
the guillotine was used to behead criminals until 1977
the rat is a vector of the plague and lives in sewers
pigs and dogs were buried with their owners
parasites such as lice and fleas feed on blood
the group demanded equal rights for black people and women
many refugees were deported to the island in 1922
Jews were expelled from the city and their houses were burned
the party was banned for inciting hatred against foreigners
I will send you the file tomorrow and call your office
you should add a reference to the second sentence
you are right and I am going to fix it
we know where the treasure is buried said the pirate
they hope you enjoy the concert
he came home late and went straight to bed
her hot soup and his cold beer stood on the table
die Stadt wurde im Krieg zerstört und die Bewohner wurden vertrieben
das Schwein ist ein Allesfresser
du kannst den Artikel gern verbessern
er wurde 1944 im Lager erschossen
la ville fut brûlée et ses habitants furent massacrés
le maire était un médecin connu
tu peux ajouter une source si tu veux
les femmes obtinrent le droit de vote en 1944
el rey fue asesinado por su hermano
la perra tuvo seis cachorros
te voy a mandar el libro la semana que viene
los judíos fueron expulsados de España en 1492""".splitlines()
