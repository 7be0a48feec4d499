"""Vocabulary of residue: what programs and templates print in place of content, in the usual wordings of several languages.

Strong fragments tell by themselves that a sentence speaks of a failed page, a demand for scripts or a missing text.  Weak ones are the words that such
sentences are made of besides; they count only next to a strong one.  All are in lower case and match at word boundaries.
"""

from __future__ import annotations


def _listed(text: str) -> frozenset[str]:
    return frozenset(p for p in (" ".join(part.split()) for part in text.split("|")) if p)


# Errors.
ERRORS = {
    "en": _listed("""not found|could not be found|cannot be found|can't be found|can't find|cannot find|couldn't find|could not find|no longer available|not available|unavailable|does not exist|doesn't exist|seem to exist|moved or deleted|
        has been moved|has been removed|access denied|permission denied|don't have permission|do not have permission|forbidden|unauthorized|unauthorised|not authorized|not authorised|bad request|bad gateway|gateway|server error|
        an error|unexpected error|unknown error|fatal error|error occurred|error has occurred|error code|http error|error|went wrong|oops|whoops|try again|retry|refresh the page|session|expired|log in|sign in|timed out|timeout|
        too many requests|rate limit|scheduled maintenance|down for maintenance|maintenance|temporarily|not be loaded|could not load|failed to load|unable to load|could not be opened|cannot be displayed|could not be delivered|
        could not be retrieved|unable to complete|unable to connect|unable to handle|unable to access|can't connect|cannot connect|database connection|access to this|denied|blocked|interrupted|network change|exhausted|can't be reached|cannot be reached|took too long|isn't working|did not answer|did not respond|not responding|connection refused|connection reset|connection was reset|connection to|
        invalid|missing|uncaught|exception|traceback|most recent call last|stack trace|null pointer|segmentation fault|core dumped|no such file|not implemented|method not allowed|service is down|overloaded|contact the administrator|
        contact support|quota exceeded|upstream|proxy error|host error|dns|runtime error|unexpected token|unexpected end of|undefined index|undefined variable|heap space|out of range|no module named|cannot get|logon denied|security service|online attacks|come back later|file not|in fetch|stack overflow|out of memory|syntax error|warning"""),
    "it": _listed("""non trovata|non trovato|non è stata trovata|non è stato trovato|impossibile trovare|non esiste|non disponibile|non è disponibile|non più disponibile|non è più disponibile|accesso negato|accesso non autorizzato|non autorizzato|
        non autorizzata|non si dispone|vietato|richiesta non valida|errore|si è verificato|qualcosa è andato storto|non ha funzionato|andato storto|riprova|riprovare|sessione|scaduta|scaduto|effettuare l'accesso|effettua l'accesso|nuovamente l'accesso|login|permessi|autorizzazioni|tempo scaduto|
        troppe richieste|manutenzione|temporaneamente|impossibile caricare|impossibile visualizzare|impossibile completare|impossibile aprire|spostata o eliminata|spostato o eliminato|rimossa o eliminata|qualche minuto|connessione rifiutata|connessione interrotta|eccezione|ci scusiamo per il disagio"""),
    "de": _listed("""nicht gefunden|nicht auffinden|konnte nicht|konnten nicht|kann nicht angezeigt|existiert nicht|nicht mehr verfügbar|nicht verfügbar|nicht erreichbar|zugriff verweigert|zugriff nicht|keine berechtigung|verboten|ungültige anfrage|
        ungültig|fehler|fehlermeldung|ist aufgetreten|schiefgelaufen|schief gelaufen|versuchen sie es|erneut versuchen|sitzung|abgelaufen|melden sie sich|anmelden|zeitüberschreitung|zu viele anfragen|wartungsarbeiten|
        wartung|vorübergehend|laden fehlgeschlagen|fehlgeschlagen|verbindung|ausnahme|hoppla|interner serverfehler|serverfehler"""),
    "fr": _listed("""introuvable|connexion impossible|retiré ou déplacé|a été retiré|a été retirée|non trouvée|non trouvé|pas été trouvée|pas été trouvé|n'existe pas|n'existe plus|n'est pas disponible|n'est plus disponible|indisponible|accès refusé|accès interdit|accès non autorisé|pas l'autorisation|non autorisé|
        interdit|requête invalide|requête incorrecte|erreur|les droits|droits nécessaires|vous identifier|reconnecter|s'est produite|est survenue|mal passé|mal tourné|réessayer|réessayez|nouveau plus tard|session|expiré|expirée|reconnecter|vous connecter|délai|dépassé|trop de requêtes|
        maintenance|temporairement|impossible d'afficher|impossible de charger|impossible de trouver|n'a pas pu|connexion refusée|connexion interrompue|déplacé ou supprimé|a été déplacé|a été supprimé|oups|veuillez patienter"""),
    "more": _listed("""lo sentimos|no encontrada|no encontrado|no se encuentra|no se ha encontrado|no se pudo|no existe|no disponible|acceso denegado|prohibido|se ha producido|ha ocurrido|ocurrió un error|algo salió mal|inténtelo|inténtalo|intente de nuevo|
        vuelva a intentarlo|sesión|ha caducado|ha expirado|demasiadas solicitudes|mantenimiento|não encontrada|não encontrado|não existe|não disponível|indisponível|acesso negado|proibido|ocorreu um erro|algo deu errado|
        tente novamente|sessão|expirou|manutenção|erro|niet gevonden|bestaat niet|niet beschikbaar|toegang geweigerd|er is een fout|fout opgetreden|er ging iets mis|probeer het|opnieuw|sessie|verlopen|onderhoud|tijdelijk"""),
}

# What could not be done, as (forms of denial, what is denied) of each language; every form goes with every verb.
FAILURES = {
    "en": (
        _listed("can't|cannot|can not|could not|couldn't|unable to|failed to|fails to|trouble|problem|problems|we can't|we couldn't"),
        _listed("open|load|find|reach|connect|process|display|access|complete|handle|show|retrieve|finding|loading|opening|connecting|displaying|be found|be opened|be loaded|be displayed|be reached|be processed|be retrieved"),
    ),
    "en states": (_listed("not|isn't|is not|aren't|wasn't|no longer|currently not|stopped|temporarily"), _listed("available|accessible|reachable|responding|loaded|displayed|suspended|offline")),
    "it": (
        _listed("non|impossibile|non è|non è più|non è possibile|non è stato possibile|non può essere|momentaneamente|temporaneamente"),
        _listed("disponibile|accessibile|raggiungibile|trovata|trovato|aprire|caricare|visualizzare|mostrare|trovare|completare|elaborare|connettersi|visualizzata|caricata|sospeso|sospesa"),
    ),
    "de": (
        _listed("nicht|nicht mehr|konnte nicht|konnten nicht|kann nicht|derzeit nicht|momentan nicht|leider nicht"),
        _listed("gefunden|geladen|angezeigt|dargestellt|geöffnet|aufgerufen|abgerufen|verfügbar|erreichbar|verbunden|verarbeitet|zugänglich"),
    ),
    "fr": (
        _listed("pas|plus|n'est plus|n'est pas|impossible de|impossible d'|n'a pas pu|n'a pu|momentanément"),
        _listed("accessible|disponible|afficher|charger|ouvrir|trouver|joindre|traiter|se connecter|être affichée|être chargée|être trouvée|être trouvé|indisponible"),
    ),
    "es": (_listed("no|no está|no se puede|no se pudo|no ha podido|não|não está|não foi possível"), _listed("disponible|accesible|cargar|abrir|mostrar|encontrar|conectar|procesar|disponível|acessível|carregar|encontrada")),
}
# Of what such a failure is told; without one of them in the sentence it may be anybody's.
FAILING_THINGS = _listed("""page|pages|site|website|server|browser|app|application|url|link|resource|content|request|internet|document|file|service|safari|chrome|firefox|
    pagina|sito|risorsa|contenuto|documento|servizio|richiesta|connessione|applicazione|seite|webseite|website|inhalt|dokument|datei|dienst|anfrage|verbindung|anwendung|javascript|contenu|document|fichier|ressource|serveur|requête|connexion|navigateur|
    página|sitio|recurso|contenido|servidor|servicio|solicitud|conteúdo|serviço""")

# Demands for scripts, cookies or proof that one is human.
SCRIPTS = {
    "en": _listed("""javascript|java script|scripts|scripting|enable cookies|cookies|your browser|this browser|unsupported browser|outdated browser|not a robot|you are a robot|captcha|are human|you're human|security check|connection is secure|attention required|cloudflare|ddos protection|
        loading|please wait|just a moment|one moment|redirected|redirecting|being checked|checking your|ad blocker|adblocker|turn them on|enable it|will not work without|reload|requires flash|plugin"""),
    "it": _listed("gli script|script|abilita i cookie|abilitare i cookie|i cookie|il tuo browser|il browser|il suo browser|un robot|sei umano|essere umano|verifica di sicurezza|caricamento|attendere prego|attendi|ricaricare|ricarica|reindirizzato"),
    "de": _listed("skripte|skripts|ohne javascript|cookies aktivieren|ihr browser|dein browser|der browser|kein roboter|ein mensch|sicherheitsprüfung|wird geladen|lädt|laden sie|bitte warten|einen moment|neu laden|weitergeleitet|erforderlich"),
    "fr": _listed("les scripts|scripts|activer les cookies|les cookies|votre navigateur|ton navigateur|le navigateur|un robot|n'êtes pas un robot|vérification que|êtes humain|vérification de sécurité|chargement|veuillez patienter|un instant|recharger|rechargez|redirigé"),
    "more": _listed("su navegador|tu navegador|habilite|habilitar|active javascript|un robot|cargando|espere|seu navegador|habilite|ative|carregando|aguarde|uw browser|je browser|schakel|inschakelen|bezig met laden|even geduld"),
}

# Filler and notices that a text is still to come.
FILLERS = {
    "en": _listed("""lorem ipsum|lipsum|placeholder|place holder|dummy text|dummy copy|sample text|example text|filler text|filler|blind text|goes here|text here|content here|add a description|add a title|to follow|to be completed|to be added|to be inserted|to be supplied|
        to be provided|to be determined|to be announced|to be confirmed|tbc|tbd|tba|todo|to do|fixme|coming soon|under construction|content pending|pending|your text|add text|replace this|will be replaced|only a sample|enter the body|enter the text|quick brown fox|lazy dog|click to edit|
        edit this|no content|empty page|intentionally left blank|work in progress|draft text|test post|hello world|the layout|layout|write this|edit or remove|edit this text"""),
    "it": _listed("testo segnaposto|segnaposto|testo fittizio|testo finto|testo di prova|testo di esempio|testo d'esempio|riempitivo|da completare|da inserire|da compilare|da definire|in costruzione|in allestimento|inserire qui|inserire testo|testo qui|"
        "contenuto in arrivo|prossimamente|verrà pubblicato|sarà pubblicato|sostituire con|qui va il testo|seguirà"),
    "de": _listed("blindtext|typoblindtext|platzhalter|platzhaltertext|mustertext|beispieltext|fülltext|dummytext|text folgt|folgt in kürze|inhalt folgt|alle buchstaben|später ersetzt|hier steht|hier text|text einfügen|text eingeben|noch auszufüllen|wird ergänzt|wird nachgereicht|"
        "im aufbau|in vorbereitung|in bearbeitung|kommt bald|ohne inhalt|nicht wirklich gelesen|taxi quer durch bayern|boxer jagen"),
    "fr": _listed("texte factice|faux texte|texte fictif|texte de remplissage|texte d'exemple|texte provisoire|texte à venir|contenu à venir|à remplacer|à compléter|à remplir|à définir|à insérer|insérer le texte|insérez|votre texte|texte ici|mise en page|"
        "en construction|en cours de rédaction|en préparation|bientôt disponible|vieux whisky au juge|espace réservé"),
    "more": _listed("texto de relleno|texto de ejemplo|texto aquí|marcador de posición|próximamente|en construcción|por completar|texto de exemplo|texto aqui|em breve|em construção|a completar|voorbeeldtekst|plaatshouder|tekst volgt|binnenkort|in aanbouw"),
}

# What sentences about pages, browsers and texts are made of besides.
CARRIERS = {
    "en": _listed("""page|pages|site|website|web site|app|application|document|file|resource|url|link|address|content|text|copy|paragraph|ruling|decision|record|viewer|portal|server|service|system|network|database|browser|request|requested|
        please|you need to|you must|need to|must|needs|requires|required|enable|enabled|disable|disabled|turn on|switch on|switched off|turned off|activate|allow|allowed|support|supported|does not support|view|run|use|read|open|opening|display|
        work|properly|correctly|continue|to continue|proceed|reload the page|go back|back to|return to|home|homepage|home page|search|help|contact|administrator|webmaster|later|again|in a few|minutes|seconds|moments|wait|click|button|below|
        looking for|you asked for|you requested|you are|you have|your|for this|this is|on this|of this|in your|settings|account|password|user|the following|occurred|processing|process|while|verify|confirm|complete|proof|security|
        sorry|internal|nginx|apache|tomcat|json|at position|thread|main|java|index|notice|looks like|section|inline|purposes|own|try|site's|reference number|change|detected|apologise|apologize|inconvenience|we|our|we're|it may have been|has occurred|have been|nothing happens|if nothing|before|replace|with the|show|shows|first|second|body|here|kind|report|detail|id"""),
    "it": _listed("""pagina|pagine|sito|applicazione|documento|risorsa|indirizzo|contenuto|testo|paragrafo|sentenza|decisione|portale|server|servizio|sistema|rete|browser|richiesta|richiesto|richiesti|richiede|per favore|si prega di|è necessario|
        bisogna|deve|devi|occorre|attivare|attiva|attivato|abilitare|abilita|abilitato|disabilitato|disattivato|consentire|supporta|non supporta|visualizzare|utilizzare|usare|leggere|aprire|continuare|per continuare|proseguire|torna|tornare|
        ricerca|contatta|contattare|amministratore|più tardi|tardi|di nuovo|minuti|secondi|qualche|stai cercando|che stai|cercata|cercato|spiacenti|ci dispiace|imprevisto|impostazioni|utente|verifica|conferma|confermare|questa|questo|sistema|programmata|al momento|nel tuo|da questo|del server|interno|qui|prova"""),
    "de": _listed("""seite|seiten|webseite|website|anwendung|dokument|datei|inhalt|text|absatz|entscheidung|urteil|portal|server|dienst|system|netzwerk|browser|anfrage|angefordert|angeforderte|angeforderten|bitte|sie müssen|
        müssen|muss|benötigt|erfordert|aktivieren|aktivieren sie|aktiviert|deaktiviert|einschalten|eingeschaltet|erlauben|unterstützt|anzuzeigen|anzeigen|auszuführen|nutzen|verwenden|lesen|öffnen|fortzufahren|fortfahren|zurück|startseite|
        suche|kontakt|administrator|später|erneut|noch einmal|minuten|sekunden|gesuchte|leider|entschuldigung|unerwarteter|unerwartet|einstellungen|benutzer|bestätigen|bestätigen sie|diese|dieses|in ihrem|derzeit|zurzeit|aufgerufene|gewünschte|aufzurufen|mehr|aufgrund|wegen|um|hier|ein"""),
    "fr": _listed("""page|pages|site|application|document|fichier|ressource|adresse|contenu|texte|paragraphe|décision|arrêt|portail|serveur|service|système|réseau|navigateur|requête|demandé|demandée|demande|veuillez|merci de|merci d'|vous devez|
        devez|doit|nécessite|requiert|activer|activez|activé|désactivé|autoriser|autorisez|prend en charge|ne prend pas en charge|afficher|utiliser|exécuter|lire|ouvrir|continuer|pour continuer|poursuivre|retour|accueil|recherche|contacter|
        contactez|administrateur|plus tard|tard|de nouveau|minutes|secondes|que vous recherchez|recherchez|recherchée|désolé|nous sommes désolés|inattendue|inattendu|quelque chose|paramètres|utilisateur|vérifier|confirmez|confirmer|cette|correctement|fonctionner|pris en charge|afficher|dans votre|du serveur|interne|ici"""),
    "more": _listed("página|busca|aplicación|documento solicitado|sitio|documento|servidor|servicio|navegador|por favor|solicitada|solicitado|más tarde|de nuevo|más|tarde|esta|javascript|serviço|solicitada|mais tarde|pagina|deze|dienst|later|gevraagde|alstublieft"),
}

# Parts of the names that programs give their errors.
PROGRAM_ERRORS = ("error", "exception", "failure", "warning")

# Words by themselves that stand for text where nothing has been written.
NONSENSE = frozenset("foo bar baz qux quux blah bla yada xxx yyy zzz asdf qwer test testing text dummy sample lorem ipsum lipsum todo tbd tbc tba".split())
# Rows of the usual keyboards.
KEYBOARD_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiopü", "asdfghjklöä", "yxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn", "1234567890")

# Words that ordinary sentences of the usual languages hardly do without.
FUNCTION_WORDS = frozenset("""
the and that was of to is are were by for with from this which be as on it has had not or he his she her they at an but if no so who will would can may their its under any
di che della il la del dei delle dell le gli un una è per con da dal dalla nel nella si al alla sono come ha questo anche i non e o a in se su
der und dass nicht die das den dem des ein eine einer ist war von zu mit auf für im sich sie es er wird wurde nach bei als auch an aus hat oder
les que du de une pour dans par sur pas au aux ce cette qui est en elle ne son sa ses avec été ou l d et il à
el los las y por para como más su al ser fue não com uma os as foi pelo do da dos em na no het een van zijn op te niet dat
""".split())  # fmt: skip

# Words of the standard filler paragraph and of those that generators add.
LATIN_WORDS = frozenset("""
lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi
aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
vivamus pellentesque morbi tristique senectus malesuada vestibulum tortor feugiat ultricies mauris nec vel sus praesent at vero eos accusamus iusto odio ducimus
""".split())
# Parts of Latin syllables.
LATIN_ONSETS = ("qu", *(a + b for a in "bcdfgpt" for b in "lr"), "sc", "sp", "st", "scr", "spr", "str", "ps", "gn", *"bcdfghlmnprstv")
LATIN_VOWELS = ("ae", "oe", "au", "eu", "ui", "ia", "io", "iu", *"aeiou")
LATIN_CODAS = ("nct", "ns", "nt", "nc", "rs", "st", "ps", *"bcdlmnprstx")

# What the fields of a template are called, in several languages.
FIELD_WORDS = frozenset("""
name first last full surname forename title date day month year time place city town country address street phone email number no id code reference ref amount sum currency price total company firm organisation organization client customer
user party parties claimant respondent defendant plaintiff appellant applicant judge court seat docket case file subject text description signature position role product order invoice your the of
nome cognome titolo data giorno mese anno luogo città indirizzo numero importo somma società cliente utente parte convenuto attore ricorrente resistente giudice corte sede causa oggetto firma il la del della di
vorname nachname titel datum tag monat jahr ort stadt adresse anschrift straße nummer betrag summe firma gesellschaft kunde benutzer partei kläger beklagte beklagter richter gericht sitz aktenzeichen betreff unterschrift der die das
nom prénom titre jour mois année lieu ville adresse numéro montant somme société client utilisateur demandeur défendeur requérant intimé juge cour siège dossier objet le du de nombre fecha
""".split())  # fmt: skip

# What a template asks its user to do.
INSTRUCTIONS = _listed("""insert|inserted|to be inserted|enter|enter your|fill in|type here|choose|select|add your|tbc|tbd|tba|to be completed|to be confirmed|to be added|to be determined|inserire|inserisci|completare|compilare|da completare|da inserire|da compilare|
    einsetzen|eintragen|einfügen|eingeben|ausfüllen|bitte ergänzen|ergänzen|compléter|completer|insérer|insérez|saisir|saisissez|à remplir|à compléter|renseigner|indiquer|introducir|rellenar|inserir|preencher|invullen|todo""")

# What programs print for no value; the first kind is no word of any language, the second is.
PROGRAM_VALUES = ("NaN", "NaT", "[object Object]", "#REF!", "#N/A", "#VALUE!", "#NAME?", "#DIV/0!", "(null)", "<null>", "%!s(<nil>)")
EMPTY_WORDS = ("undefined", "null", "NULL", "None", "nil")

# Words after which a name, number or date belongs.
LABELS = frozenset("""of di de du des del della von vom zu v vs contro gegen c gegen contre and e et und docket no nr n r.g aktenzeichen dossier case file ref reference date court judge between tra zwischen entre
corte tribunale tribunal obergericht gericht landgericht cour by from to dated the il la der die das le""".split())
# Words that name a marker, so that what follows is spoken of.
MARKER_WORDS = frozenset("""marker markers placeholder placeholders field fields tag tags token tokens string strings variable variables segnaposto marcatore campo campi platzhalter feld felder marke marken vermerk balise balises champ champs
repère repères mention variabile variabili variablen marcador""".split())
OPEN_QUOTES, CLOSE_QUOTES = "«„“\"'‘‚‹”", "»”“\"'’›‘"
