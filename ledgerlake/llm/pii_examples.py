"""The small labelled table the sequence model is trained on: sentences with their personal information marked.

Rows are drawn, with a fixed seed, from sentence patterns whose slots carry their label, and from sentences put together
of common words. Patterns and word lists were written without the documents at hand, then widened by further kinds of
sentence where a first model erred on sf0.1; values come from generators of the forms that numbers, addresses and names
take anywhere.
"""

from __future__ import annotations

import random
import re

#: Rows of the table; the bound of the training sample.
ROWS, SEED = 80000, 7
#: Shares of a row's own words that are replaced by others.
UNKNOWN = (0.0, 0.0, 0.1, 0.3, 0.5)
#: First names of several languages.
FIRST = """
Mohamed Ahmed Hassan Hussein Ali Omar Youssef Ibrahim Khalid Abdellah Abderrahim Mustapha Said Rachid Driss Aziz Brahim Hamza Ilyas Anas Ayoub Zakaria Jamal Nabil Karim Samir
Fatima Khadija Aicha Meryem Zineb Salma Naima Latifa Houda Samira Nadia Hanane Ghizlane Soukaina Ilham Loubna Asmae Hajar Imane Leila Rim Sanaa Wafae Yasmina Amina Malika
Jean Pierre Michel Philippe Alain Bernard Christophe Nicolas Laurent Olivier Antoine Guillaume Thomas Étienne François Gérard Hervé Didier Luc Marc Julien Mathieu Rémi
Marie Nathalie Isabelle Catherine Sylvie Anne Valérie Sophie Céline Caroline Hélène Élise Chloé Camille Pauline Agnès Brigitte Florence Laure Inès Jeanne Clémence Maëlle
John James Robert William David Richard Charles Daniel Matthew Peter Mark George Kevin Brian Edward Steven Mary Patricia Jennifer Elizabeth Susan Margaret Karen Emily Alice Grace
Carlos Miguel Javier Lucía Carmen Elena Giulia Marco Paolo Francesca Hans Jürgen Klaus Ingrid Sofia Ivan Olga Anna Chen Wei Yuki Amadou Fatou Moussa Awa Kwame
Claire Léa Manon Lucas Hugo Louis Paul Victor Arthur Jules Emma Adam Sara Salim Tarik Adil Hind Nora Mehdi Kenza Othmane Reda Amal Bouchra Rania Bilal Walid Younes Simon Oscar
Jean-Pierre Marie-Claire Anne-Laure Jean-Luc Abdel-Karim Fatima-Ezzahra Mohamed-Amine Lalla-Zahra Pierre-Yves Marie-Thérèse
""".split()
PARTICLES = ["El", "Ben", "Ait", "Aït", "Bel", "de", "Le", "Al", "Van", "da", "Ould", "Bou"]
#: Kinds of ways, buildings and streets.
WAYS = ["rue", "avenue", "av.", "boulevard", "bd", "bd.", "place", "impasse", "allée", "chemin", "route", "quai", "passage", "square", "cours", "ruelle", "rond-point", "sentier", "montée"]
BUILDINGS = ["immeuble", "imm.", "résidence", "rés.", "lotissement", "lot.", "lot", "bâtiment", "bât.", "tour", "villa", "quartier", "zone industrielle", "Z.I.", "zone d'activités", "zone d'activité", "quartier", "espace", "centre", "hay", "parc"]
STREETS = ["Street", "St.", "Road", "Avenue", "Lane", "Drive", "Court", "Place", "Square", "Way", "Boulevard", "Crescent", "Terrace", "Row", "Close"]
ARABIC_WAYS, ARABIC_WORDS = ["شارع", "زنقة", "حي", "ساحة"], ["النخيل", "الأمل", "السلام", "الورود", "المسيرة", "الحرية", "الزيتون", "الرياض"]
ARABIC_TOWNS = ["الرباط", "فاس", "طنجة", "مراكش", "أكادير", "مكناس", "وجدة", "تطوان"]
#: Nouns that give ways, buildings and places their names.
PLACE_WORDS = "Soleil Rivière Lilas Roses Acacias Tilleuls Écoles Gare Mairie Fontaines Jardins Collines Lac Montagne Vallée République Liberté Victoire Paix Résistance Espérance Commerce Industrie Plateau Source Prairie Chênes Orangers Dattiers Figuiers Citronniers Mimosas Cascade Forêt Horloge Arènes Remparts Halles Château Université".split()
ENGLISH_WORDS = "Maple Station Church Victoria Green Park River Bridge Hill Garden West North South Elm Chestnut Abbey Queen Market Spring Garden Forest Meadow Windsor Grove Union Liberty".split()
#: Common words of reports, for sentences without personal information.
NOUNS = "croissance marge activité trésorerie production demande clientèle logistique filiale exportation récolte matière énergie amortissement provision dépréciation emprunt échéance taux rendement capital action dividende réserve inventaire stock commande contrat appel offre chantier usine atelier ligne navire parc flotte réseau agence gamme marque licence logiciel serveur budget calendrier objectif indicateur seuil ratio coût charge produit recette dépense vente achat loyer impôt taxe redevance pénalité litige assurance sinistre garantie caution hypothèque titre portefeuille placement obligation bon trésor devise change couverture swap option norme méthode estimation hypothèse jugement risque contrôle procédure rapport annexe tableau note bilan compte exercice trimestre semestre période clôture ouverture variation hausse baisse écart reprise dotation".split()
VERBS = "progresse recule atteint dépasse représente couvre concerne affecte compense explique reflète traduit limite accompagne soutient dégrade améliore réduit renforce maintient confirme retrouve conserve justifie nécessite entraîne génère absorbe finance amortit".split()
ADJECTIVES = "net brut courant récurrent significatif modéré stable soutenu global moyen annuel mensuel interne externe local étranger industriel commercial financier fiscal social technique durable récent ancien prévu réalisé cumulé partiel total".split()
ENGLISH = "revenue margin growth demand output capacity plant pipeline inventory borrowing interest covenant dividend shareholder filing audit standard lease asset liability provision segment region product customer supplier freight price volume currency hedge outlook target quarter year increase decrease impact recovery slowdown investment project permit license contract order backlog staff training safety emission energy water".split()
ENGLISH_VERBS = "rose fell remained reached exceeded covers reflects includes supports offsets requires improved declined stabilised accounts depends".split()
ARABIC = "ارتفع انخفض بلغ سجل الإنتاج المبيعات الأرباح الديون الاستثمار الموارد السوق النمو الطلب القطاع النتائج التكاليف الأسعار خلال مقارنة بنسبة نهاية الفصل الأول الثاني المجلس الجمعية العامة القرار التقرير الحسابات المصاريف".split()
HEADS = ["Conseil d'administration", "Assemblée générale ordinaire", "Comité d'audit", "Directoire", "Direction financière", "Conseil de surveillance", "Président-directeur général", "Directeur des systèmes d'information", "Commissaire aux comptes", "Chief Executive Officer", "Board of Directors", "Ministère de l'Industrie", "Bourse des valeurs", "Banque Centrale", "Cour d'appel", "Tribunal de commerce", "Code général des impôts", "Grand Théâtre", "Hôtel de Ville", "Palais des Congrès", "Université Polytechnique", "Fédération Nationale du Commerce", "Union Européenne", "Afrique du Nord", "Moyen Atlas", "Plan Vision", "Chambre de Commerce", "Trésorier Payeur", "Secrétaire général", "Responsable Qualité", "Audit & Conseil Associés", "Investor Relations", "Annual General Meeting", "Mesdames, Messieurs les Actionnaires"]
SECTORS = ["CHIMIE", "TELECOM", "TEXTILE", "MINES", "AGRO", "CREDIT", "HOTELS", "PHARMA", "ENERGIE", "BETON", "AUTO", "MEDIA", "TRANSPORT", "ASSURANCE", "PAPIER", "SUCRE", "ACIER", "HOLDING", "IMMOBILIER", "CIMENTS", "ASSURANCES", "DISTRIBUTION", "LOGICIELS", "BANQUE", "PETROLE", "GAZ", "EAUX", "PORTS", "LEASING", "FINANCE", "SERVICES", "TECHNOLOGIES", "ELECTRONIQUE", "MATERIAUX", "PLASTIQUES", "EMBALLAGE", "BOISSONS", "LAITERIE", "HUILES", "PECHE", "SANTE", "LABO", "TOURISME", "LOISIRS", "CABLES", "METAUX", "VERRE", "BOIS", "CUIR", "SEMENCES", "ENGRAIS", "INVEST", "CAPITAL", "TRAVAUX", "INGENIERIE", "MARITIME", "AERIEN", "NEGOCE", "INDUSTRIES", "GROUP"]
#: Sentences with slots, one a line; N name, E e-mail, P phone, I identity number, A and B addresses, F function, M amount.
PATTERNS = """
{N} rejoint l'équipe en qualité de {F}.
Le mandat de {N} arrive à son terme en {y}.
{N}, {F}, a répondu à la presse.
Selon {N}, la {w} devrait se poursuivre.
Interrogée sur ce point, {N} précise que la {w} reste suffisante.
Notre {F}, {N}, se tient à votre écoute : {P}.
MM. {N} et {N} quittent leurs fonctions le {d}.
M. {N} et Mme {N} ont été élus scrutateurs.
Madame {N} est remplacée par Monsieur {N}.
Me {N}, avocat au barreau de {T}, assistait la société.
Dr {N} et Pr {N} siègent au comité scientifique.
Composition : {N}, {F} ; {N}, membre ; {N}, membre.
Ont signé : {N} et {N}, pour la partie cédante.
Remerciements à {N} pour sa relecture.
« La {w} est acquise », a déclaré {N}.
« {S} », a indiqué {N} au cours de la réunion.
« {S} », a expliqué {N}, {F}.
« {S} », ajoute {N}.
« {S} » a conclu {N} devant la presse.
"{Z}" added {N}.
"{Z}" {N} declared.
Texte présenté par {N}, {F}.
Motion présentée par {N} et soutenue par {N}
Document signé par {N}
Société représentée par {N}, {F}
Étude dirigée par {N}, relue par {N}
Bonjour {N}, votre demande est traitée.
Bonjour {N},
Bonsoir {N}, merci de rappeler le {P}.
Cher {N}, la réunion aura lieu le {d}.
Hello {N}, please confirm.
Mr {N} joined the firm in {y}.
Mr {N} and Mrs {N} resigned.
Mrs {N}, {F}, retired in {y}.
Ms {N} left.
Le comité est composé de {N} (président), de {N} (membre) et de {N} (membre).
Bureau : {N} (présidente), {N} (rapporteur)
Étaient également présents {N}, {N} et {N}.
Absents : {N}, {N}. Excusée : {N}.
Sont représentés : {N} et {N}
Les héritiers de {N} vendent {n} titres.
La veuve de {N} conserve {n} titres.
{N} et son fils {N} détiennent {n} %.
Né en {y}, {N} est ingénieur.
{N}, né le {d} à {T}
Lettre de {N} reçue le {d}
Demande de {N} du {d}
{N}.
M. {N}
Mme {N}
Mlle {N}
Monsieur {N}
Signature : {N}
Signature .......... {N}
Pour le conseil : {N}
Pour la direction, {N}
Le {F}, {N}, a rendu son avis le {d}.
La {F}, {N}
Porteurs : {N} ; {A} ; {P}.
Registre : {N} ; {I} ; {A}.
{N} ; pièce d'identité {I} ; {A} ; {P}
Nom : {N} - Adresse : {A} - Tél. : {P} - Mail : {E}
Nom {N} / Courriel {E} / Domicile {A}
L'actionnaire habite {A}.
Elle habite au {A} avec sa famille.
Il loge {A} et possède {n} actions.
Les époux {N}, domiciliés {A}, vendent {n} parts.
Votes reçus de {N}, {A}
{N}, {A}, a demandé la {w}.
Pour copie conforme, {N}, {F}
Rédigé par : {N}, le {d}
Rapporteur : {N}
{F} : {N}
{F}\\n{N}
{N}\\n{F}
{N}\\n{A}
{N}\\n{A}\\n{P}
{N}\\n{F}\\nTél. {P}\\n{E}
{N} | {F} | {E} | {P}
{N} ; {F} ; {P}
- {N}, {n} actions\\n- {N}, {n} actions
1. {N}\\n2. {N}\\n3. {N}
Nom et prénom | Fonction | Depuis\\n{N} | {F} | {y}\\n{N} | {F} | {y}
Liste des présents : {N} ({n} voix), {N} ({n} voix), {N} ({n} voix).
L'actionnaire {N} (carte nationale {I}) a demandé la parole.
Porteur : {N}, CIN : {I}, résidant au {A}.
Copie de la pièce d'identité {I} jointe au dossier de {N}.
Il est titulaire du passeport numéro {I}, délivré le {d}.
Passport no. {I} was issued to {N} in {y}.
His ID card ({I}) was checked at the entrance by {N}.
Numéro de sécurité sociale : {I}.
Assurée sous le matricule {I} auprès de la caisse sociale, elle a perçu {M}.
CNI {I} – {N} – {A}
Identité vérifiée ({I}), signature de {N} recueillie.
L'intéressé, porteur de la carte n° {I}, habite {A}.
CIN {I}
CIN n° {I}, {N}
(CIN : {I})
C.I.N. {I} délivrée à {T}
{N} – CIN {I} – {P}
Carte d'identité nationale {I} au nom de {N}
Carte d'identité n° {I} présentée par {N}
Pièce d'identité : {I} ({N})
Pièce n° {I} produite à l'appui de la demande.
Pièce {I}, {N}, {A}
Titulaire de la pièce d'identité {I}, {N} vote par procuration.
Passeport {I} valable jusqu'en {y}
Passeport n° {I} – {N}
Le passeport de {N} porte le numéro {I}.
Holder of passport {I}, {N} voted by mail.
ID number: {I} ({N})
National identity card no. {I}, {N}
National ID {I} – {N} – {B}
Identity document {I} was produced by {N}.
Numéro d'assuré : {I}, {N}
Immatriculé(e) à la CNSS sous le numéro {I}
N° CNSS {I} – salarié {N}
Affilié n° {I} à la caisse de sécurité sociale, {N} part en retraite.
Social insurance number {I} belongs to {N}.
Social security no. {I}
Inscrit à la caisse de retraite sous le n° {I}, il conteste sa pension.
Immatriculée à la caisse sous le numéro {I}, {N} a été indemnisée.
Salarié immatriculé à la caisse maladie sous le n° {I}
Affiliation de {N} à la caisse sous le n° {I}
Assurance maladie n° {I} ({N})
Numéro d'immatriculation sociale {I}
Her passport number is {I}; she votes by proxy.
Passport number {I} ({N})
The passport of {N}, number {I}, has expired.
{N} joined in {y}, passport number is {I}.
Passeport {I}, {N}, {F}
Passeport {I} remis par {N}
Passeport : {I}
né en {y}, pièce n° {I}, {P}
Mandant {N}, pièce n° {I}
Pièce {I} ; {A}
Pièce : {I}
Carte {I}, {N}
National ID {I}
Registered shareholder {N}, national ID {I}, {B}
ID {I}, {B}
Le salarié {N}, assuré social n° {I}, conteste son licenciement.
Matricule de sécurité sociale {I} ; domicile : {A}.
Bénéficiaire : {N}, carte {I}, téléphone {P}
Déclarant : {N} ; identité : {I} ; courriel : {E}
بطاقة التعريف الوطنية رقم {I} باسم {N}
Le mandataire {N}, identifié par la CIN {I}, a remis le pouvoir.
Merci d'écrire à {E} avant le {d}.
Courriel : {E}
E-mail: {E} / Phone: {P}
Pour vous désinscrire, envoyez un message à {E}.
Une question ? {E} ou {P}.
Write to {E} or call {P} during office hours.
Please contact {N} at {E}.
You may reach {N}, our {F}, on {P}.
{E} est l'adresse à utiliser pour les réclamations.
Expéditeur : {N} <{E}>
To: {E}\\nCc: {E}\\nSubject: {w} {y}
Les documents sont disponibles sur demande ({E}).
L'adresse {E} n'est plus relevée depuis {y} ; utiliser {E}.
Téléphone : {P}
Tél./Fax : {P} / {P}
Fax {P}
GSM : {P}, bureau : {P}
Numéro d'appel : {P} (coût d'un appel local).
Le service client répond au {P} de 9 h à 18 h.
Rappelez le {P} ou écrivez-nous : {E}.
Hotline {P}, ext. {n}
Un numéro vert, le {P}, est ouvert aux porteurs.
En cas d'urgence composer le {P}.
Appelez-nous ({P}).
Appelez le {P} pour confirmer.
Contact : {N} ({P})
Contact téléphonique ({P}) du lundi au vendredi
Joignable au {P}
Ligne directe : {P}
Tél : {P} - Fax : {P}
Tél. : {P}
Tel. {P} / Fax {P}
T. {P} – F. {P} – {E}
Mobile : {P}
Portable {P}, domicile {P}
Télécopie {P}
Télécopieur n° {P}
Par fax au {P}
Fax n° {P}, à l'attention de {N}
Standard téléphonique {P}
Le secrétariat ({P}) prend les inscriptions.
Tel: {P}
Phone: {P}; fax: {P}
Telephone {P}, fax {P}
Mobile number {P}
Call us on {P}.
Reach the desk at {P} or by e-mail ({E}).
For questions dial {P}.
Our switchboard ({P}) is open daily.
WhatsApp {P}
Renseignements : {P} ou {P}
Inscription auprès de {N} au {P}.
Téléphonez au {P}.
{P}
{P}\n{E}
{E} | {P}
{E} – {P}
رقم الهاتف {P}
الفاكس {P}
للاستفسار: {P}
Nos bureaux ont déménagé au {A}.
Demeurant au {A}
Demeurant {A}, {N} est né en {y}.
Domiciliée {A}, {N} est sans emploi.
Domicilié au {A}
Domicile : {A}
Résidant {A}
Qui réside au {A} depuis {y}.
Sise {A}, la boutique emploie {n} personnes.
Sis au {A}, l'entrepôt couvre {n} m².
Le siège social est transféré au {A}.
Siège social : {A}
Siège : {A}
Agence de {T} : {A}
Établissement principal : {A}
Lieu de la réunion : {A}
Livraison : {A}
Expédier à : {N}, {A}
À l'adresse suivante : {A}.
Rendez-vous au {A} le {d}.
Étude notariale, {A}
Cabinet de {N}, {A}
L'appartement du {A} est vendu.
Head office: {B}
Office: {B}
Address: {B}
Located at {B}, the plant employs {n} people.
Her home, {B}, was sold.
Please write to {N}, {B}.
Send documents to {B} by {d}.
The notice was posted to {B}.
{A}
{B}
Adresse du siège : {A}
Adresse : {A} - Téléphone : {P}
Le dépôt, situé {A}, ferme en {y}.
Un local a été loué à {A} pour {M} par mois.
Courrier à envoyer au {A}.
Réunion tenue {A}, à {n} heures.
The company moved to {B} in {y}.
Registered office: {B}.
Mail the signed form to {N}, {B}.
{N} resides at {B} and holds {n} shares.
Domicilié(e) {A}, {N} déclare détenir {n} titres.
M. {N} demeurant à {A} a vendu {n} actions à {N}.
Succession {N} : notaire {N}, {A}, {P}.
Chère {N}, nous accusons réception de votre lettre.
Monsieur {N},\\nNous avons pris note de votre demande.
Dear Ms {N}, thank you for your enquiry.
Dear {N},\\nPlease find attached the {e} report.
Cordialement,\\n{N}
Best regards,\\n{N}\\n{F}\\n{P}
Bien à vous, {N}
Sincerely, {N}
(s) {N}
Signé : {N}
Le {F} {N} a ouvert les débats.
« La {w} reste notre priorité », souligne {N}.
"We expect {e} to improve," said {N}, {F}.
{N} told analysts that {e} was on track.
The board appointed {N} as {F} on {d}.
{N} and {N} did not attend.
According to {N}, {e} remains weak.
Prepared by {N} and reviewed by {N}.
Proxy given to {N} (passport {I}), {B}.
Visa : {N}, {d}
Vu {N}
Dossier suivi par {N} ({P}, {E})
Affaire {N} contre la société : audience le {d}.
Décès de {N}, ancien {F}, survenu en {y}.
Prix décerné à {N} pour sa thèse.
Formateur : {N}. Participants : {N}, {N}.
السيد {N} عضو المجلس.
اتصلوا بنا على الرقم {P}.
البريد الإلكتروني: {E}
المرجو الكتابة إلى {E} أو الاتصال على {P}
هاتف: {P} / فاكس: {P}
العنوان: {C}
يقع المقر في {C}.
رقم البطاقة الوطنية {I}.
"""
#: Sentences without personal information, among them those that look like it.
PLAIN = """
{H}
{H} : séance du {d}
{H} de {U}
Le {H} s'est réuni le {d} à {T}.
{U} et {U} ont signé un accord de partenariat.
{U}, société anonyme au capital de {M}, inscrite au registre n° {d5}.
ICE {d8}{d7} – IF {d8} – RC {T} {d5} – Patente {d8}
Facture {L2}{d6} du {d}, montant {M}.
Référence {L2}-{d6}, série {L2}{d5}.
Bon n° {d6}, bordereau {d7}, colis {d9}.
Code ISIN MA{d9}{d1}, ticker {L3}.
Lot {d6}, code barre {d9}{d4}.
Compte bancaire {d3} {d3} {d9}{d7} {d2}
RIB : {d3} {d3} {d4} {d4} {d4} {d4} {d2}
Homologation {L2} {d6}, brevet {L1}{d7}, marque déposée {d6}.
Immatriculation du véhicule : {d5}-{L1}-{d2}.
Contrat n° {d7}/{y}, avenant {n}, lot {n}.
Marché {d2}/{y} attribué à {U}.
Numéro de TVA {d8}, numéro d'employeur {d7}.
Version {n}.{n1}.{n1} du {d}
Article {n} de la loi {d2}-{d2}, décret n° 2-{d2}-{d3}.
ISO {d4}:{y}, norme IFRS {n1}, NF EN {d5}
Page {n} sur {n}
Note {n} : {S}
{n}.{n1} {S}
{S}
{S} {S}
{S} {M} contre {M} en {y}.
La {w} passe de {n},{n1} % à {n},{n1} %.
Total {M} {M} {M}
{w} | {n} {d3} | {d3} {d3} | ({n} {d3})
{d3} {d3} {d3},{d2}
Cours au {d} : {n},{d2} DH ; volume : {d6} titres.
Abonnez-vous : @{w}{n1}, page {w}.{w}, site www.{w}{w}.com
Vendu à 3 pour 2 @ {n},{n1} DH l'unité
Voir https://www.{w}.org/{w}/{y}.pdf
Twitter : @{w} ; LinkedIn : {w}-{w}
Le complexe {H} de {T} ouvrira en {y}.
La ville de {T} compte {n} agences et {n} points de vente.
Une usine sera construite à {T}, sur un terrain de {n} hectares.
Le groupe exploite {n} hôtels à {T}, {T} et {T}.
La route nationale reliant {T} à {T} sera élargie.
L'avenue principale de la ville est en travaux.
Le quartier des affaires regroupe {n} immeubles.
La rue commerçante a souffert de la baisse de fréquentation.
Rue piétonne, place centrale et boulevard extérieur seront rénovés.
Madame la Directrice et Monsieur le Trésorier présentent la {w}.
M. le Président lève la séance à {n} h {d2}.
Monsieur le Ministre a visité le chantier.
Le Directeur Général Délégué présente les comptes.
Messieurs les administrateurs ont approuvé la {w}.
Le titulaire de la carte bancaire règle {M}.
Le numéro de téléphone est obligatoire dans le formulaire.
L'adresse électronique doit être tenue à jour.
The ID of each asset is stored in the register.
Employees must carry a passport when travelling.
{Z}
{Z} {Z}
MAD {n}.{n1} million, {n}% above {y}.
Capacity: {n},{d3} tonnes; yield {n}.{n1}%.
Q{n1} {y}: {Z}
Vision {y}, Plan Horizon {y}, Programme Elan
Bourse : {U} +{n},{d2} %, {U} -{n1},{d2} %
Lundi {n} janvier, mardi {n} février, mercredi {n} mars {y}
{d} {n}h{d2} {M}
Sigles : {L3}, {L3}, {L4}
Abréviations : {L3} ({w}), {L4} ({w})
Cotation {L3}, {L3} et {L3} suspendue.
{L3} / {L4} / {L3}
Implantations : {T}, {T}, {T}.
Succursales à {T} et {T} ; agence à {T}.
De {T} à {T}, le trafic {w} recule.
Les sites de {T} ({n} salariés) et de {T} ({n} salariés) fusionnent.
{T}, le {d}
Fait à {T}, le {d}.
Aéroport de {T}, port de {T}, gare de {T}
The {T} and {T} sites were closed.
Hotels in {T}, {T} and {T} reopened.
Villa, résidence ou immeuble : le {w} immobilier ralentit.
Construction de {n} villas et {n} appartements à {T}.
Zone industrielle de {T} : {n} lots vendus.
Le boulevard est bordé de {n} commerces.
Banque Centrale, Trésor Public et {U}
Groupe {T} Invest, {U}, {U}
{U} : {M}
Actionnaires : {U} {n} %, {U} {n} %, divers {n} %
{U} détient {n} % de {U}.
Le {H} remercie les équipes de {U}.
{H}, {H} et {H}
Chers actionnaires, la {w} est bonne.
Dear shareholders, {e} has improved.
Mesdames, Messieurs,
Total général {n} {d3} {d3} ({n} {d3})
Solde ({n} {d3} {d3}) ; solde {n}.{d3}.{d3},{d2}
Année {y} {y} {y}
{y} | {y} | {y}
Valeur nette : {d3} {d3} {d3} DH ({n},{n1} %)
Volume {d2}.{d3}.{d3} / {d2}.{d3}.{d3}
Délai {n}-{n} jours, plage {y}/{y}
Numéro de pièce comptable {d6}, journal {L2}.
Numéro de dossier {d7}, guichet {n}.
Carte grise {d5}, carte bancaire {d4} {d4} {d4} {d4}
Registre {d5}, folio {n}, volume {d6}
Numéro de commande {L2} {d6}
Purchase order {L2}-{d6} dated {d}
Invoice no. {d8}, batch {L1}{d6}
Serial number {L2}{d7}
Company number {d8}, VAT {L2}{d9}
رقم السجل التجاري {d5}
______________
________________________ {w}
{Q} {M} {Q}
{Q} {n},{d2} {Q}
{Q}. {Q}. {Q} {y}.
Appel d'offres n° {d5}/{y}
Convention n° {d4}/{y} signée le {d}
Décision n° {d5}/{y} du {H}
Arrêté n° {d5}/{y}, permis {d5}/{y}
Affaire enregistrée sous le n° {d5}/{y}
Requête n° {d5}/{y} rejetée ; arrêt n° {d4}/{y}
Marché n° {d5}/{y} relatif au {w}, lot n° {n}
Consultation {d5}/{y} sans suite
Produit réf. {L2}{d6} retiré de la vente
Article {L2} {d6} en rupture
Le modèle {L2}{d6} est abandonné.
Numéro de lot {L2} {d6}
Le lot {L2} {d6} est détruit.
Lot de production {L2} {d6}, lot de fabrication {L1}{d6}
Lots de fabrication {L2}{d6} et {L2} {d6} rappelés
Le lot de matière {L2}-{d6} est conforme.
Rappel des lots {L2} {d6} et {L2} {d6}
Pièce détachée {L2}-{d6}, moteur n° {L2}{d7}
La série {L2}{d6} sera remplacée par la série {L1}{d6}.
Palette {d9}, conteneur {L4}{d7}
Brevet {L2}{d6} déposé en {y}
Brevet n° {L2} {d6} et modèle {L2}{d6}
Le dépôt du brevet {L2}{d6} protège la {w}.
Machine {L2} {d6}, capteur {L2}{d6}
Commande {L2}-{d6} et facture {L2} {d6}
Facture {d9} impayée
Facture n° {d9}, avoir n° {d9}
RC {d5}
RC n° {d5}, ICE n° {d8}{d7}
ICE : {d8}{d7}
IF n° {d8}, TP {d8}
Identifiant fiscal {d8}, identifiant commun {d8}{d7}
Inscrite au registre du commerce de {T} sous le n° {d5}
La filiale (RC {d5}, IF {d8}) est dissoute.
Numéro d'employeur : {d7}
Cotisations versées sous le numéro d'employeur {d7}
Affiliation de l'entreprise n° {d7}
SIREN {d9}, SIRET {d9}{d5}
Agrément {L2} {d6}
Code {L2}{d8}, titre {L2}{d9}
Valeur {L2}{d8} cotée à {n},{d2}
Titres (code {L2}{d8}) : {d6} échangés
L'Hôtel {V} a fermé.
Le Grand Hôtel {V} et le Palais {V} ont ouvert en {y}.
Le Complexe {V} de la {V} compte {n} chambres.
Club {V} {V} : {n} lits
Restaurant {V}, café {V}, marina {V}
La marque {V} {V} et la gamme {V}
Le navire {V} {V} est à quai.
Centre commercial {V} {V}
Les Jardins de {V}, le Village {V}
Parc {V}, stade {V}, musée {V}
{K}
{K} {y}
{K} : {M}
{K} | {K} | {K}
Hôtel {V}
{Q}
{Q} {n}.{n1}%
{Q} {M}
<p>{S}</p>
<td>{w}</td><td>{n} {d3}</td>
{w};{n};{y}
# {H}
* {S}
• {S} ;
---------------
................ {n}
\\t{w}\\t\\t{n} {d3}\\t{d3}
§ {n1}.{n1} – {S}
{S} (voir note {n}).
« {S} »
Objet : {w} {y}
Annexe {n} – {H}
Ordre du jour : 1. {w} ; 2. {w} ; 3. {w}.
"""
FUNCTIONS = ["directeur général", "directrice financière", "président", "présidente", "secrétaire", "administrateur", "responsable des achats", "gérant", "associé", "trésorière", "contrôleur de gestion", "chef de projet", "chairman", "chief financial officer", "company secretary", "general counsel", "analyst", "Directeur commercial", "Présidente du conseil", "Administrateur indépendant", "Chef comptable", "Head of Sales", "commissaire aux comptes", "vice-président", "liquidateur"]
ARABIC_DIGITS = str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩")
CONSONANTS, VOWELS = "b c d f g h j k l m n p r s t v z br ch dr gh kh ll mm nn ou qu rr sh ss tr zz".split(), "a e i o u ai ou ia eu é".split()
ENDS = ["", "", "n", "r", "s", "l", "d", "t", "x", "ni", "ri", "ard", "eau", "oui", "ane", "mann", "son", "ez", "ier", "di", "chi", "ko"]
TLDS = ["com", "ma", "fr", "org", "net", "eu", "info", "co.ma", "co.uk", "example", "test", "invalid", "gov.ma"]


class Draw:
    """Values of the slots, from one stream of random numbers."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def letters(self, n: int) -> str:
        return "".join(self.r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))

    def invented(self, least: int = 1, most: int = 3) -> str:
        """A made-up word of some syllables."""
        return "".join(self.r.choice(CONSONANTS) + self.r.choice(VOWELS) for _ in range(self.r.randint(least, most))) + self.r.choice(ENDS)

    def surname(self) -> str:
        last = self.invented().capitalize()
        return f"{self.r.choice(PARTICLES)} {last}" if self.r.random() < 0.15 else f"{last}-{self.invented().capitalize()}" if self.r.random() < 0.05 else last

    def first(self) -> str:
        return self.r.choice(FIRST) if self.r.random() < 0.75 else self.invented(1, 2).capitalize()

    def name(self) -> str:
        r, first, last = self.r, self.first(), self.surname()
        gap = r.choices([" ", "\xa0", "\n", "  "], [85, 7, 6, 2])[0]
        upper = last.upper() if r.random() < 0.35 else last
        initial = f"{first[0]}."
        form = r.random()
        if form < 0.22:
            return r.choice([initial] * 5 + [f"{initial} {self.letters(1)}.", f"{initial}{self.letters(1)}.", f"{first[0]}.-{self.letters(1)}."]) + gap + upper
        if form < 0.30:
            return f"{first} {self.letters(1)}." + gap + upper
        if form < 0.45:
            return upper.upper() + gap + first if r.random() < 0.7 else last + gap + first
        if form < 0.52:
            return first + " " + self.first() + gap + upper
        if form < 0.62:
            return (first + gap + last).upper()
        return first + gap + upper

    def phone(self) -> str:
        """Digits in groups, with or without country prefix, brackets and separators; sometimes letters O for zeros."""
        r = self.r
        sep = r.choices([" ", "\xa0", ".", "-", "", "/"], [45, 8, 12, 14, 18, 3])[0]
        kind = r.random()
        if kind < 0.12:
            body = f"({self.digits(3)}) {self.digits(3)}-{self.digits(4)}" if r.random() < 0.5 else f"{self.digits(3)}{sep or ' '}{self.digits(3)}{sep or ' '}{self.digits(4)}"
            out = r.choice(["", "+1 ", "001 "]) + body
        else:
            country = r.choice(["212", "212", "33", "44", "34", "1", "216", "213", "49", "971", "225", "39"])
            groups = r.choice([[2, 2, 2, 2], [2, 2, 2, 2], [2, 2, 2, 2], [2, 2, 2, 2], [2, 6], [8], [3, 3, 2], [4, 4], [2, 3, 3], [3, 2, 3]])
            area = self.digits(1) if r.random() < 0.6 else self.digits(2)
            parts = [area] + [self.digits(n) for n in groups] if r.random() < 0.5 else [area + self.digits(groups[0]), *[self.digits(n) for n in groups[1:]]]
            body = sep.join(parts)
            start = r.random()
            if start < 0.45:
                out = "0" + body
                if r.random() < 0.15:
                    out = out.replace("/", sep).replace(sep, "/", 1) if sep else out
            elif start < 0.6:
                out = f"+{country}{sep}{body}"
            elif start < 0.72:
                out = f"00{country}{sep}{body}"
            elif start < 0.82:
                out = f"(+{country}){r.choice([' ', '', sep])}{body}"
            elif start < 0.93:
                out = f"{r.choice(['+', '00'])}{country}{r.choice([' ', '', sep])}(0){r.choice([' ', '', sep])}{body}"
            else:
                out = f"(0){body}"
        if r.random() < 0.04:
            out = out.replace("0", "O")
        return out.translate(ARABIC_DIGITS) if r.random() < 0.06 else out

    def identity(self) -> str:
        """Card, passport and insurance numbers: letters and digits, or digits in groups."""
        r, n = self.r, self.r.choice([5, 6, 6, 6, 7, 7])
        code, number = self.letters(r.choice([1, 1, 2, 2, 2])), self.digits(n)
        forms = [code + number] * 8 + [code.lower() + number] * 2 + [f"{code} {number}", f"{code} {number}", f"{code}-{number}", f"{code} {number[:3]} {number[3:]}", f"{code}-{number[:3]} {number[3:]}", f"{code}{number[:3]} {number[3:]}", f"{code}.{number}"]
        forms += [self.digits(9), self.digits(9), f"{self.digits(3)} {self.digits(3)} {self.digits(3)}", self.digits(2) + self.letters(2) + self.digits(5), f"{r.choice('12')} {self.digits(2)} {self.digits(2)} {self.digits(2)} {self.digits(3)} {self.digits(3)}", f"{self.digits(3)}-{self.digits(3)}-{self.digits(3)}"]
        return r.choice(forms)

    def word(self) -> str:
        return self.r.choice(NOUNS)

    def email(self) -> str:
        r = self.r
        plain = str.maketrans("éèëïêàçôîÉüäöíáñ", "eeeieacoieuaoian")
        a, b = (re.sub(r"[^a-z]", "", x.lower().translate(plain)) or "x" for x in (self.first(), self.surname()))
        local = r.choice([f"{a}.{b}", f"{a[0]}.{b}", f"{a}_{b}", f"{a}{b}", f"{b}{r.randint(1, 99)}", f"{a}-{b}", f"{a[0]}{b}", f"{a}.{b}+{self.word()}", r.choice(["contact", "info", "direction", "service.client", "bureau", "comptabilite", "rh", "support", "secretariat"])]).translate(plain)
        host = r.choice([self.invented(), f"{self.invented()}-{self.invented()}", f"mail.{self.invented()}", f"{self.invented()}{self.invented()}"]).translate(plain) + "." + r.choice(TLDS)
        kind = r.random()
        if kind < 0.55:
            out = f"{local}@{host}"
        elif kind < 0.65:
            out = r.choice([f"{local} @ {host}", f"{local}@ {host}", f"{local} @{host}"])
        elif kind < 0.73:
            at = host.index(".")
            out = r.choice([f"{local}@{host[:at]} {host[at:]}", f"{local}@{host[:at]} . {host[at + 1 :]}", f"{local}@{host[: at + 1]} {host[at + 1 :]}", f"{local.replace('.', ' .')}@{host}", f"{local.replace('.', ' . ')}@{host}"])
        else:
            at = r.choice([" [at] ", "[at]", "(at)", " (at) ", " arobase ", " at ", " {at} ", " (arobase) ", "[arobase]", " AT "])
            dot = r.choice([".", " point ", "(point)", " [point] ", "[dot]", " dot ", "(dot)", " . ", " (point) "])
            out = local.replace(".", dot if r.random() < 0.4 else ".") + at + host.replace(".", dot)
        return r.choice([out] * 7 + [out.upper(), out.title()])

    def town(self) -> str:
        r = self.r
        name = self.invented(1, 3).capitalize()
        return r.choice([name] * 8 + [f"{r.choice(['Sidi', 'Aïn', 'Dar', 'Oued', 'El', 'Ras', 'Bab', 'Ksar', 'Souk', 'Beni', 'Bou', 'New', 'La'])} {name}"] * 6 + [f"Saint-{name}", f"{name}-sur-Mer", f"Port-{name}", f"{name} {self.invented().capitalize()}"])

    def way(self) -> str:
        r = self.r
        named = [f"{r.choice(['des ', 'du ', 'de la ', 'de l’', 'de ', ''])}{r.choice(PLACE_WORDS)}", f"{self.first()} {self.surname()}", f"{r.randint(1, 99)}", f"{r.choice(PLACE_WORDS)} {r.choice(['I', 'II', 'III', 'IV'])}", f"{self.town()}", f"du {r.randint(1, 31)} {r.choice(['mai', 'août', 'novembre'])}", f"du {r.choice(PLACE_WORDS)} {r.choice(['Bleu', 'Vert', 'Blanc', 'Neuf', 'Vieux'])}"]
        return f"{r.choice(WAYS)} {r.choice(named)}"

    def building(self) -> str:
        r = self.r
        return f"{r.choice(BUILDINGS)} {r.choice([r.choice(PLACE_WORDS), 'Al ' + self.invented(1, 2).capitalize(), 'Les ' + r.choice(PLACE_WORDS), 'El ' + self.invented(1, 2).capitalize(), self.invented().capitalize(), self.letters(1), str(r.randint(1, 90)), r.choice(['Nord', 'Sud', 'Est', 'Ouest', 'industriel', 'administratif', 'central'])])}"

    def address(self) -> str:
        r, town, code, n = self.r, self.town(), self.digits(5), self.r.randint(1, 400)
        way, sep = self.way(), r.choice([", ", ", ", " ", " - ", " - ", "\n", " – "])
        number = r.choice([f"{n}", f"{n}", f"{n},", f"{n} bis", f"{n} ter", f"{n}{r.choice('AB')}", f"n° {n}", f"N°{n}", f"{n}-{n + 2}"])
        end = r.choice([town, f"{code} {town}", f"{code} {town}", f"{code} {town.upper()}", town.upper(), f"{town} {code}", f"B.P. {r.randint(1, 900)}, {town}"])
        inner = r.choice([f"{self.building()}", f"appt {r.randint(1, 60)}", f"{r.randint(1, 9)}e étage", f"bureau {r.randint(1, 90)}", f"{self.building()}, {r.randint(1, 9)}ème étage", f"porte {r.randint(1, 30)}"])
        cap = way[0].upper() + way[1:]
        forms = [f"{number} {way}{sep}{end}"] * 5 + [f"{self.building()}, {inner}, {n}, {way}{sep}{end}", f"angle {way} et {self.way()}{sep}{end}", f"{cap} n° {n}, {self.building()}{sep}{end}"] * 2 + [f"{number} {way}{sep}{inner}, {end}", f"{self.building()}, {number} {way}{sep}{end}", f"{self.building()}, {inner}, {number} {way}{sep}{end}", f"angle {way} et {self.way()}{sep}{end}", f"{cap} n° {n}{sep}{end}", f"{cap}, {self.building()}, {end}", f"{self.building()}{sep}{end}", f"{cap}{sep}{end}", f"{number} {way}, {inner}{sep}{end}"]
        out = r.choice(forms)
        return out.upper() if r.random() < 0.12 else out.title() if r.random() < 0.06 else out

    def english_address(self) -> str:
        r, town, n = self.r, self.town(), self.r.randint(1, 999)
        street = f"{r.choice([r.choice(ENGLISH_WORDS), self.invented().capitalize(), 'Old ' + r.choice(ENGLISH_WORDS)])} {r.choice(STREETS)}"
        inner = r.choice([f"Suite {r.randint(1, 90)}", f"Flat {r.randint(1, 40)}", f"Floor {r.randint(1, 20)}", f"Unit {r.randint(1, 30)}", f"Apt {r.randint(1, 90)}"])
        end = r.choice([town, f"{town} {self.digits(5)}", f"{town}, {self.digits(5)}", f"{self.digits(5)} {town}"])
        out = r.choice([f"{n} {street}, {end}"] * 3 + [f"{inner}, {n} {street}, {end}", f"{n} {street}, {inner}, {end}", f"{n} {street}\n{end}"])
        return out.upper() if r.random() < 0.12 else out

    def arabic_address(self) -> str:
        r, n = self.r, str(self.r.randint(1, 300))
        n = n.translate(ARABIC_DIGITS) if r.random() < 0.4 else n
        return r.choice([f"{n} {r.choice(ARABIC_WAYS)} {r.choice(ARABIC_WORDS)}، {r.choice(ARABIC_TOWNS)}", f"{n}، {r.choice(ARABIC_WAYS)} {r.choice(ARABIC_WORDS)}، {r.choice(ARABIC_TOWNS)}", f"{r.choice(ARABIC_WAYS)} {r.choice(ARABIC_WORDS)} رقم {n} {r.choice(ARABIC_TOWNS)}"])

    def amount(self) -> str:
        r, gap = self.r, self.r.choice([" ", "\xa0", "."])
        size = gap.join([str(r.randint(1, 999))] + [self.digits(3) for _ in range(r.randint(0, 3))])
        cents = r.choice(["", "", f",{self.digits(1)}", f",{self.digits(2)}", f".{self.digits(1)}"])
        unit = r.choice(["DH", "MDH", "KDH", "dirhams", "millions de dirhams", "MAD", "€", "M€", "euros", "millions", "milliards de dirhams", "$", "USD", "m dirhams", "tonnes", "m²"])
        return r.choice([f"{size}{cents} {unit}"] * 5 + [f"{r.choice(['MAD', 'EUR', 'USD', '$', '€'])} {size}{cents}", f"({size}{cents})", f"{size}{cents}{r.choice(['m', 'bn', 'M', 'k'])} {unit}", f"MAD {size}{cents} M"])

    def date(self) -> str:
        r, y = self.r, self.r.randint(1995, 2030)
        return r.choice([f"{r.randint(1, 31)}/{r.randint(1, 12):02}/{y}", f"{r.randint(1, 31):02}.{r.randint(1, 12):02}.{y}", f"{r.randint(1, 31)} {r.choice('janvier février mars avril mai juin juillet août septembre octobre novembre décembre'.split())} {y}", f"{r.choice('January March June July October December'.split())} {r.randint(1, 31)}, {y}", f"{y}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1, 31)} {r.choice('April May August November'.split())} {y}"])

    def company(self) -> str:
        r = self.r
        return r.choice([f"{self.invented(2, 3).upper()} {r.choice(SECTORS)}"] * 3 + [f"{self.invented(2, 3).capitalize()} {r.choice(SECTORS).capitalize()}", f"{self.invented().upper()} SA", f"Groupe {self.invented().capitalize()}", f"{self.invented().capitalize()} & Cie", f"Société {self.invented().capitalize()}", f"{self.letters(3)} Group"])

    def sentence(self) -> str:
        r = self.r
        phrase = lambda: f"{r.choice(['la', 'le', 'une', 'un', 'cette', 'notre', 'sa', 'leur', 'chaque'])} {r.choice(NOUNS)} {r.choice(ADJECTIVES + ['de ' + n for n in NOUNS[:40]])}"
        out = f"{phrase()} {r.choice(VERBS)} {phrase()}"
        if r.random() < 0.5:
            out += f" {r.choice(['malgré', 'après', 'grâce à', 'compte tenu de', 'hors', 'avec', 'pour', 'contre', 'au titre de', 'depuis'])} {phrase()}"
        if r.random() < 0.35:
            out += r.choice([f", soit {self.amount()}", f" en {r.randint(1990, 2030)}", f" de {r.randint(1, 99)},{r.randint(0, 9)} %", f" à {self.town()}", f" au {self.date()}", f" chez {self.company()}", f" ({r.randint(1, 400)} jours)", f" selon le {r.choice(HEADS)}"])
        return out[0].upper() + out[1:] + r.choice([".", ".", ".", "", " ;", "!"])

    def english_sentence(self) -> str:
        r = self.r
        out = f"{r.choice(['The', 'Our', 'Its', 'A', 'This'])} {r.choice(ENGLISH)} {r.choice(ENGLISH)} {r.choice(ENGLISH_VERBS)} {r.choice(['by', 'to', 'the', 'with', 'in', 'at', 'for'])} {r.choice(ENGLISH)}"
        return out + r.choice([".", "", f" in {r.randint(1995, 2030)}.", f", or {self.amount()}.", f" at {self.company()}.", f" near {self.town()}.", "; it's due to weather.", " (unaudited)."])

    def arabic_sentence(self) -> str:
        return " ".join(self.r.choice(ARABIC) for _ in range(self.r.randint(3, 9))) + self.r.choice([".", "", f" {self.r.randint(1995, 2030)}.", "،"])

    def instead(self, word: str, share: float) -> str:
        """A word of a pattern, or in its place any other of its case, so that no pattern is learnt by heart."""
        r = self.r
        if r.random() >= share:
            return word
        other = r.choice(ARABIC) if word[0] > "\u0600" else r.choice([r.choice(NOUNS), r.choice(ADJECTIVES), r.choice(VERBS), r.choice(ENGLISH), self.invented()])
        return other.upper() if word.isupper() else other.capitalize() if word[0].isupper() else other

    def fill(self, slot: str) -> tuple[str, str]:
        """(text, label) of a slot; label blank where it is no personal information."""
        r = self.r
        marked = {"N": (self.name, "NAME"), "E": (self.email, "EMAIL"), "P": (self.phone, "PHONE"), "I": (self.identity, "ID"), "A": (self.address, "ADDRESS"), "B": (self.english_address, "ADDRESS"), "C": (self.arabic_address, "ADDRESS")}
        if slot in marked:
            return marked[slot][0](), marked[slot][1]
        if slot[0] == "d" and slot != "d":
            return self.digits(int(slot[1:])), ""
        if slot[0] == "L":
            return self.letters(int(slot[1:])), ""
        plain = {
            "M": self.amount, "n": lambda: str(r.randint(1, 600)), "n1": lambda: self.digits(1), "y": lambda: str(r.randint(1990, 2035)), "T": self.town, "w": self.word, "e": lambda: r.choice(ENGLISH), "U": self.company, "d": self.date,
            "F": lambda: r.choice(FUNCTIONS), "H": lambda: r.choice(HEADS), "S": self.sentence, "V": lambda: r.choice([self.invented(1, 2).capitalize(), r.choice(PLACE_WORDS), r.choice(ENGLISH_WORDS)]), "K": lambda: " ".join(r.choice(NOUNS).capitalize() for _ in range(r.randint(2, 3))), "Z": self.english_sentence, "Q": self.arabic_sentence,
        }
        return plain[slot](), ""


#: The last words before a number.
CUE = re.compile(r"(?:\S+\s*){0,5}$")


def patterns() -> tuple[list[str], list[str]]:
    """(sentences with marked slots, sentences without)."""
    return tuple([line.replace("\\n", "\n").replace("\\t", "\t") for line in block.strip().splitlines()] for block in (PATTERNS, PLAIN))


def labelled_table(rows: int = ROWS, seed: int = SEED, marked: list[str] | None = None, plain: list[str] | None = None) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, spans) rows; a row joins one to five sentences the ways a text does. ``marked`` and ``plain`` hold patterns
    to draw from instead of all, so that some can be kept for a test."""
    draw = Draw(seed)
    both = patterns()
    marked, plain = marked or both[0], plain or both[1]
    out = []
    for i in range(rows):
        text, spans = "", []
        unknown = draw.r.choice(UNKNOWN)
        for k in range(draw.r.randint(1, 5)):
            pattern = marked[(i + 7 * k) % len(marked)] if draw.r.random() < 0.42 else draw.r.choice(plain)
            if text:
                text += draw.r.choice(["\n", " ", " ", "\n\n", " ", "  "])
            parts = re.split(r"(\{\w+\})", pattern)
            for part, after in zip(parts, [*parts[1:], ""]):
                if part.startswith("{"):
                    value, label = draw.fill(part[1:-1])
                    if label:
                        spans.append((len(text), len(text) + len(value), label))
                    text += value
                else:
                    # numbers are told apart by the words right before them, so those stay
                    kept = CUE.search(part).start() if after[1:2] in ("I", "d", "L") else len(part)
                    text += re.sub(r"[^\W\d_]{2,}", lambda m: draw.instead(m.group(), unknown), part[:kept]) + part[kept:]
        out.append((text, spans))
    return out
