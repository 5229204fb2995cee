"""Text that the residue models of problem 2 are fitted on: written for this module, none of it taken from a corpus.

Sentences are put together from parts, so that the models see how such text is made and not a list of it.
"""

from __future__ import annotations

import itertools
import random
import re

# parts: things that fail | how they fail
_THINGS = {
    "es": "La URL|Esta dirección|La sección|El fichero|El artículo|El portal|La aplicación|El sitio|La imagen|La base de datos|El módulo|El panel|La carpeta|La descarga|La consulta|Este enlace|Esta página|Este documento|El visor de mapas|El recurso pedido|La ficha técnica|El servidor web|El formulario en línea",
    "en": "The URL|This address|The section|The attachment|The article|The portal|The application|The website|The image|The database|The module|The dashboard|The folder|The download|The query|This link|The web page|The requested document|The map service|The resource|The data sheet|The host|The online form",
    "pt": "A URL|Este endereço|A seção|O anexo|O artigo|O portal|O aplicativo|O site|A imagem|O banco de dados|O módulo|O painel|A pasta|O download|A consulta|Este link|Esta página|O documento pedido|O visualizador|O recurso solicitado|A ficha técnica|O servidor web|O formulário on-line",
    "fr": "L’URL|Cette adresse|La rubrique|La pièce jointe|L’article|Le portail|L’application|Le site|L’image|La base de données|Le module|Le tableau de bord|Le dossier|Le téléchargement|La requête|Ce lien|Cette page|Le document voulu|Le service de cartes|La ressource|La notice|L’hôte|Le formulaire en ligne",
    "de": "Die URL|Diese Adresse|Der Bereich|Der Anhang|Der Artikel|Das Portal|Die Anwendung|Die Webseite|Das Bild|Die Datenbank|Das Modul|Die Übersicht|Der Ordner|Der Download|Die Abfrage|Dieser Link|Diese Seite|Das gewünschte Dokument|Der Kartendienst|Die Ressource|Das Datenblatt|Der Host|Das Formular",
}
_FAILS = {
    "es": "no pudo abrirse.|no se halla en este servidor.|ya no se encuentra en línea.|dejó de existir.|ha sido retirado.|está fuera de servicio.|no pudo mostrarse.|no se ha podido recuperar.|no contesta.|tarda demasiado.|requiere iniciar sesión.|requiere autorización.|cambió de ubicación.|se trasladó a otra dirección.|devolvió un error.|se ha eliminado.|no es accesible ahora.|caducó.|no está disponible por ahora.|no pudo cargarse.|exige permisos.|no existe o se ha movido.|no fue encontrado.|tardó mucho en responder.|dejó de responder.|que solicitó no existe.|que busca fue borrada.",
    "en": "could not be opened.|does not exist on this server.|is no longer online.|has been deleted.|has been withdrawn.|is out of service.|cannot be displayed.|failed to load.|is not responding.|took too long to respond.|requires you to sign in.|requires authorization.|was moved elsewhere.|has changed location.|returned an error.|has been removed.|is currently unavailable.|has expired.|is not available at the moment.|could not be loaded at this time.|needs special permissions.|no longer exists.|cannot be found.|timed out while loading.|stopped responding.|you requested does not exist.|you tried to reach was not found.",
    "pt": "não abriu.|não existe neste servidor.|não está mais on-line.|deixou de existir.|foi retirado.|está fora do ar.|não pode ser mostrado.|falhou ao carregar.|não responde no momento.|demora demais.|requer login.|requer autorização.|mudou de lugar.|foi movido para outro endereço.|retornou um erro.|foi excluído.|não está acessível agora.|expirou.|não está disponível agora.|não pôde ser aberto.|exige permissões.|não existe ou foi movida.|não foi localizado.|demorou muito para responder.|parou de responder.|que você pediu não existe.|que você tentou abrir foi apagada.",
    "fr": "n’a pas pu s’ouvrir.|n’existe pas sur ce serveur.|n’est plus en ligne.|a cessé d’exister.|a été retirée.|est hors service.|ne peut pas être affichée.|n’a pas pu charger.|ne répond plus.|met trop longtemps à charger.|exige une connexion.|exige une autorisation.|a changé d’emplacement.|a été déplacée ailleurs.|a renvoyé une erreur.|a été effacée.|n’est pas accessible actuellement.|a expiré.|n’est pas disponible pour le moment.|n’a pas pu être ouvert.|exige des droits.|n’existe pas ou a été déplacé.|est introuvable ici.|a mis trop de temps à répondre.|a cessé de répondre.|que vous avez demandée n’existe pas.|que vous cherchez a été supprimé.",
    "de": "konnte nicht geöffnet werden.|gibt es auf diesem Server nicht.|ist nicht mehr online.|existiert hier nicht mehr.|wurde entfernt.|ist außer Betrieb.|kann nicht angezeigt werden.|konnte leider nicht laden.|reagiert nicht.|lädt zu lange.|erfordert eine Anmeldung.|erfordert eine Berechtigung.|ist umgezogen.|wurde an eine andere Adresse verschoben.|meldete einen Fehler.|wurde gelöscht.|ist derzeit nicht zugänglich.|ist abgelaufen.|ist momentan nicht verfügbar.|konnte nicht gefunden werden.|verlangt Rechte.|ist nicht vorhanden oder verschoben.|wurde leider nicht gefunden.|hat zu lange gebraucht.|antwortet nicht mehr.|die Sie aufrufen wollten, existiert nicht.|das Sie suchen, wurde gelöscht.",
}
# whole notices of the same kind
_NOTICES = {
    "es": "Acceso denegado a este contenido.|No dispone de permiso para abrir el recurso.|La sesión caducó, inicie sesión de nuevo.|Ingrese otra vez para seguir.|Vuelva al inicio del portal.|Ir al inicio.|No encontramos lo que usted busca (404).|Inténtelo otra vez en unos minutos.|Inténtelo más adelante.|Confirme que no es un robot antes de ver el archivo.|Si el fallo sigue, avise al administrador con el código B7D0.|Indique al administrador el número E991.|Esta dirección caducó o cambió.|Espere 20 segundos, hay demasiadas solicitudes.|Necesita permisos que no tiene para ver esto.|El portal respondió con un error 503.|Ha ocurrido un error inesperado.|Se produjo un fallo al procesar su petición.|Compruebe la dirección e intente nuevamente.|Regrese a la portada del sitio.|Debe identificarse para ver esta sección.|Contenido reservado a usuarios registrados.|El servidor rechazó su conexión.|El tiempo de espera se agotó.|Sitio en mantenimiento, vuelva en unos minutos.|Su dirección IP ha sido bloqueada.|Complete el captcha para continuar.|Verifique que usted es una persona y no un robot.|Acepte las cookies para seguir navegando.|Se superó el límite de peticiones, espere un minuto.|Página no encontrada (404).|Error 500 del servidor.|Acceso no autorizado.|Acceso restringido, usted carece de permisos.|Lo sentimos, no encontramos esa dirección.|La sesión terminó por inactividad, ingrese de nuevo.|Intente más tarde o escriba a soporte.|Si el error continúa, contacte al administrador y cite el código A12F.|Volver a la página principal.|Algo falló, actualice la página.|Solicitud incorrecta.|Servicio no disponible por ahora.|Vuelva a cargar la página.|Ups, hubo un problema.|Demasiados intentos desde su equipo.",
    "en": "Access denied to this content.|You have no permission to open the resource.|The session expired, sign in again.|Log in again to carry on.|Go back to the start of the portal.|Go to start.|We could not find what you want (404).|Try again in some minutes.|Please try again later on.|Confirm you are human before opening the file.|If the fault persists, tell the administrator code B7D0.|Quote number E991 to the administrator.|That address has expired or changed.|Wait 20 seconds, there are too many requests.|You need permissions you lack to see this.|An invalid response came from the upstream server.|Oops, something is wrong here.|Nothing was found at this address.|Forbidden (403).|Bad gateway (502).|Not found.|An unexpected error occurred.|Something failed while handling your request.|Check the address and try once more.|Return to the home page.|You must log in to view this section.|Content for registered users only.|The server refused the connection.|The request timed out.|Site under maintenance, come back in a few minutes.|Your IP address has been blocked.|Solve the captcha to go on.|Verify that you are a person and not a robot.|Accept cookies to keep browsing.|Rate limit exceeded, wait a minute.|Page not found (404).|HTTP error 500.|Unauthorized access.|Access restricted, you lack the rights.|Sorry, we could not find that address.|Your session timed out, please log in.|Try later or write to support.|If this error continues, contact support and mention code A12F.|Back to the main page.|Something broke, please refresh the page.|Bad request.|Service unavailable.|Gateway timeout.|Internal error.|Reload this page.|Oops, there was a problem.|Too many attempts from your computer.|This site can’t be reached.|Permission denied.",
    "pt": "Acesso negado a este conteúdo.|Você não tem permissão para ver o arquivo.|A sessão expirou, entre outra vez.|Entre novamente para seguir.|Volte ao início do portal.|Ir ao início.|Não encontramos o que você procura (404).|Tente de novo em alguns minutos.|Tente novamente daqui a pouco.|Confirme que não é um robô antes de ver o arquivo.|Se a falha continuar, avise o administrador com o código B7D0.|Informe ao administrador o número E991.|Este endereço expirou ou mudou.|Aguarde 20 segundos, há muitas solicitações.|Precisa de permissões que você não tem para ver isto.|Ocorreu um erro inesperado.|Houve uma falha ao processar seu pedido.|Confira o endereço e tente outra vez.|Retorne à página inicial.|É preciso entrar para ver esta seção.|Conteúdo só para usuários cadastrados.|O servidor recusou a conexão.|O tempo limite se esgotou.|Site em manutenção, volte em alguns minutos.|Seu endereço IP foi bloqueado.|Resolva o captcha para continuar.|Verifique que você é uma pessoa e não um robô.|Aceite os cookies para continuar navegando.|Limite de pedidos excedido, espere um minuto.|Página não encontrada (404).|Erro 500 do servidor.|Acesso não autorizado.|Acesso restrito, você não tem direitos.|Desculpe, não achamos esse endereço.|A sessão terminou por inatividade, entre de novo.|Tente depois ou escreva ao suporte.|Se o erro persistir, contate o suporte e cite o código A12F.|Volte à página principal.|Algo falhou, atualize a página.|Pedido inválido.|Serviço fora do ar.|Recarregue a página.|Ops, houve um problema.|Muitas tentativas do seu computador.",
    "fr": "Accès refusé à ce contenu.|Vous n’avez pas l’autorisation d’ouvrir la ressource.|La session a expiré, reconnectez-vous.|Reconnectez-vous pour poursuivre.|Revenez à l’accueil du portail.|Aller à l’accueil.|Nous n’avons pas trouvé ce que vous cherchez (404).|Réessayez dans quelques minutes.|Veuillez réessayer plus tard.|Confirmez que vous n’êtes pas un robot avant de voir le fichier.|Si la panne persiste, donnez à l’administrateur le code B7D0.|Indiquez à l’administrateur le numéro E991.|Cette adresse a expiré ou changé.|Patientez 20 secondes, il y a trop de demandes.|Il faut des droits que vous n’avez pas pour voir ceci.|Une erreur inattendue s’est produite.|Votre demande n’a pas pu aboutir.|Vérifiez l’adresse et recommencez.|Revenez à la page d’accueil.|Il faut vous connecter pour voir cette rubrique.|Contenu réservé aux inscrits.|Le serveur a refusé la connexion.|Le délai d’attente est dépassé.|Site en maintenance, revenez dans quelques minutes.|Votre adresse IP a été bloquée.|Résolvez le captcha pour continuer.|Vérifiez que vous êtes une personne et non un robot.|Acceptez les cookies pour poursuivre la navigation.|Trop de demandes, patientez une minute.|Page non trouvée (404).|Erreur 500 du serveur.|Accès non autorisé.|Accès restreint, vous n’avez pas les droits.|Désolé, cette adresse est introuvable.|La session a pris fin, identifiez-vous de nouveau.|Réessayez ou écrivez à l’assistance.|Si l’erreur continue, contactez l’assistance et citez le code A12F.|Retourner à la page principale.|Un problème est survenu, actualisez la page.|Requête incorrecte.|Service interrompu.|Rechargez la page.|Oups, il y a eu un souci.|Trop de tentatives depuis votre poste.",
    "de": "Zugriff verweigert auf diesen Inhalt.|Sie haben keine Berechtigung, die Ressource zu öffnen.|Die Sitzung ist abgelaufen, bitte wieder anmelden.|Melden Sie sich erneut an.|Zurück zum Anfang des Portals.|Zum Anfang.|Wir konnten nicht finden, was Sie suchen (404).|Versuchen Sie es in einigen Minuten erneut.|Bitte später noch einmal versuchen.|Bestätigen Sie, dass Sie kein Roboter sind, bevor Sie die Datei sehen.|Bleibt das Problem, nennen Sie dem Administrator den Code B7D0.|Geben Sie dem Administrator die Nummer E991 an.|Diese Adresse ist abgelaufen oder umgezogen.|Warten Sie 20 Sekunden, es gibt zu viele Anfragen.|Sie brauchen Rechte, die Ihnen fehlen, um dies zu sehen.|Ein unerwarteter Fehler ist aufgetreten.|Ihre Anfrage konnte nicht bearbeitet werden.|Prüfen Sie die Adresse und versuchen Sie es noch einmal.|Gehen Sie zurück zur Hauptseite.|Sie müssen sich anmelden, um diesen Bereich zu sehen.|Inhalt nur für angemeldete Nutzer.|Der Server hat die Verbindung abgelehnt.|Die Zeit für die Anfrage ist überschritten.|Seite in Wartung, kommen Sie in einigen Minuten wieder.|Ihre IP-Adresse wurde gesperrt.|Lösen Sie das Captcha, um fortzufahren.|Bitte bestätigen Sie, dass Sie ein Mensch und kein Roboter sind.|Akzeptieren Sie Cookies, um weiter zu surfen.|Zu viele Anfragen, warten Sie eine Minute.|Seite nicht gefunden (404).|Fehler 500 des Servers.|Unbefugter Zugriff.|Zugriff verweigert, Ihnen fehlen die Rechte.|Diese Adresse wurde leider nicht gefunden.|Die Sitzung ist beendet, melden Sie sich wieder an.|Versuchen Sie es später oder schreiben Sie dem Support.|Wenn der Fehler bleibt, nennen Sie dem Support den Code A12F.|Zurück zur Hauptseite.|Etwas ging schief, laden Sie die Seite neu.|Ungültige Anfrage.|Dienst nicht verfügbar.|Laden Sie die Seite erneut.|Hoppla, da gab es ein Problem.|Zu viele Versuche von Ihrem Rechner.",
}
# script notices: what | needs | scripts
_SCRIPTS = {
    "es": ("Esta aplicación|Este portal|El contenido|El gráfico|La galería|Este visor|El mapa interactivo|Este sitio web", "no se muestra sin|solo funciona con|necesita que active|requiere tener habilitado|no carga sin|no puede abrirse sin", "JavaScript en el navegador.|el soporte de scripts.|scripts habilitados.|JavaScript activado."),
    "en": ("This application|This portal|The content|The chart|The gallery|This viewer|The interactive map|This website", "will not display without|only works with|needs you to enable|requires that you turn on|does not load without|cannot open without", "JavaScript in your browser.|script support.|scripts enabled.|JavaScript turned on."),
    "pt": ("Este aplicativo|Este portal|O conteúdo|O gráfico|A galeria|Este visualizador|O mapa interativo|Este site", "não aparece sem|só funciona com|precisa que você ative|requer que esteja habilitado|não carrega sem|não abre sem", "JavaScript no navegador.|suporte a scripts.|scripts habilitados.|JavaScript ativado."),
    "fr": ("Cette application|Ce portail|Le contenu|Le graphique|La galerie|Ce lecteur|La carte interactive|Ce site", "ne s’affiche pas sans|ne marche qu’avec|a besoin de|exige que vous activiez|ne charge pas sans|ne peut s’ouvrir sans", "JavaScript dans le navigateur.|la prise en charge des scripts.|scripts autorisés.|JavaScript activé."),
    "de": ("Diese Anwendung|Dieses Portal|Der Inhalt|Das Diagramm|Die Galerie|Dieser Betrachter|Die interaktive Karte|Diese Webseite", "erscheint nicht ohne|läuft nur mit|benötigt|verlangt|lädt nicht ohne|öffnet sich nicht ohne", "JavaScript im Browser.|Unterstützung für Skripte.|aktivierte Skripte.|eingeschaltetes JavaScript."),
}
_SCRIPT_NOTICES = {
    "es": "Habilite JavaScript en la configuración de su navegador.|Su explorador tiene desactivado JavaScript.|Los scripts están bloqueados: no se puede cargar el contenido.|Permita los scripts y actualice esta página.|Debe activar JavaScript antes de seguir.|Su navegador no admite scripts.",
    "en": "Turn JavaScript on in the settings of your browser.|Your browser has JavaScript disabled.|Scripts are blocked: the content cannot be loaded.|Allow scripts and refresh this page.|You must enable JavaScript before going on.|Your browser does not support scripts.",
    "pt": "Habilite o JavaScript nas configurações do navegador.|Seu navegador está com o JavaScript desativado.|Os scripts estão bloqueados: não dá para carregar o conteúdo.|Permita os scripts e atualize esta página.|É preciso ativar o JavaScript antes de seguir.|O navegador não aceita scripts.",
    "fr": "Autorisez JavaScript dans les réglages du navigateur.|Votre navigateur a désactivé JavaScript.|Les scripts sont bloqués : impossible de charger le contenu.|Autorisez les scripts puis actualisez cette page.|Il faut activer JavaScript avant de continuer.|Ce navigateur n’exécute pas les scripts.",
    "de": "Schalten Sie JavaScript in den Einstellungen des Browsers ein.|In Ihrem Browser ist JavaScript deaktiviert.|Skripte sind blockiert: der Inhalt kann nicht geladen werden.|Erlauben Sie Skripte und laden Sie diese Seite neu.|Sie müssen JavaScript aktivieren, bevor es weitergeht.|Ihr Browser unterstützt keine Skripte.",
}
# instructions of a template: do | what | where
_DO = {
    "es": ("Escriba|Inserte|Agregue|Complete|Introduzca|Indique|Reemplace|Ingrese", "su texto|un título|el subtítulo|el resumen|la descripción|el nombre del autor|la fecha|este párrafo|este bloque|la fuente|los datos del evento", "aquí|en este campo|antes de enviar|en esta casilla|por el definitivo|al publicar"),
    "en": ("Type|Insert|Add|Complete|Enter|State|Replace|Write", "your text|a title|the subtitle|the summary|the description|the author name|the date|this paragraph|this block|the source|the event details", "here|in this field|before sending|in this box|with the final one|when publishing"),
    "pt": ("Escreva|Insira|Adicione|Complete|Digite|Indique|Substitua|Informe", "seu texto|um título|o subtítulo|o resumo|a descrição|o nome do autor|a data|este parágrafo|este bloco|a fonte|os dados do evento", "aqui|neste campo|antes de enviar|nesta caixa|pelo definitivo|ao publicar"),
    "fr": ("Écrivez|Insérez|Ajoutez|Complétez|Saisissez|Indiquez|Remplacez|Entrez", "votre texte|un titre|le sous-titre|le résumé|la description|le nom de l’auteur|la date|ce paragraphe|ce bloc|la source|les données", "ici|dans ce champ|avant l’envoi|dans cette case|par le texte final|à la publication"),
    "de": ("Schreiben Sie|Einfügen:|Ergänzen Sie|Füllen Sie|Geben Sie|Nennen Sie|Ersetzen Sie|Tragen Sie", "Ihren Text|einen Titel|den Untertitel|die Zusammenfassung|die Beschreibung|den Namen|das Datum|diesen Absatz|diesen Block|die Quelle|die Angaben", "hier|in dieses Feld|vor dem Senden|in diesen Kasten|durch den endgültigen|hier ein"),
}
_FILLER = {
    "es": "Haga clic aquí para agregar un título|Agregue texto haciendo clic|Párrafo de ejemplo|Contenido de ejemplo.|Texto de prueba.|Un texto de muestra va en este párrafo.|Este apartado será reemplazado por el definitivo.|[Insertar resumen]|[Inserte el objetivo aquí]|(describa aquí el hallazgo)|<<COMPLETAR ESTE DATO>>|Título del informe|Subtítulo|Quinto nivel|Texto provisional.|Texto simulado para la maqueta.|Párrafo de muestra.|Contenido pendiente de redactar.|Bloque de ejemplo sin contenido.|Este texto es de relleno y se cambiará luego.|Pulse para añadir un título|Haga doble clic para editar|Primer nivel del esquema|Cuarto nivel|Título de la diapositiva|Nombre del autor|Pendiente de completar.|POR DEFINIR",
    "en": "Click here to add a title|Add text by clicking|Example paragraph|Example content.|Testing text.|Some sample copy goes in this paragraph.|This part will be replaced by the final one.|[Insert summary]|[Insert the goal here]|(describe the finding here)|<<COMPLETE THIS VALUE>>|Report title|Subtitle|Fifth level|Dummy text.|Mock text for the layout.|Sample paragraph.|Content to be written.|Example block without content.|This text is filler and will be changed later.|Tap to add a title|Double-click to edit|First level of the outline|Fourth level|Slide title|Author name|To be completed.|TO BE DEFINED|Placeholder text.",
    "pt": "Clique aqui para adicionar um título|Adicione texto clicando|Parágrafo de exemplo|Conteúdo de exemplo.|Texto de teste.|Um texto de amostra entra neste parágrafo.|Esta parte será substituída pela definitiva.|[Inserir resumo]|[Inserir o objetivo aqui]|(descreva aqui o achado)|<<PREENCHER ESTE DADO>>|Título do relatório|Subtítulo|Quinto nível|Texto provisório.|Texto simulado para o layout.|Parágrafo de amostra.|Conteúdo a ser escrito.|Bloco de exemplo sem conteúdo.|Este texto é só enchimento e será trocado depois.|Toque para adicionar um título|Clique duas vezes para editar|Primeiro nível do esquema|Quarto nível|Título do slide|Nome do autor|A ser completado.|A DEFINIR",
    "fr": "Cliquez ici pour ajouter un titre|Ajoutez du texte en cliquant|Exemple de paragraphe|Contenu d’exemple.|Texte de test.|Un texte d’exemple vient dans ce paragraphe.|Cette partie sera remplacée par la version finale.|[Insérer un résumé]|[Insérer l’objectif ici]|(décrire ici le constat)|<<COMPLÉTER CETTE DONNÉE>>|Titre du rapport|Sous-titre|Cinquième niveau|Texte provisoire.|Texte factice pour la maquette.|Paragraphe d’exemple.|Contenu à rédiger.|Bloc d’exemple sans contenu.|Ce texte sert de remplissage et sera changé ensuite.|Touchez pour ajouter un titre|Double-cliquez pour modifier|Premier niveau du plan|Quatrième niveau|Titre de la diapositive|Nom de l’auteur|À compléter.|À DÉFINIR",
    "de": "Hier klicken, um einen Titel hinzuzufügen|Text durch Anklicken einfügen|Beispielabsatz|Inhalt als Beispiel.|Text zum Testen.|In diesem Absatz steht später der Text.|Dieser Teil wird durch den endgültigen ersetzt.|[Zusammenfassung einfügen]|[Ziel hier einfügen]|(den Befund hier beschreiben)|<<ANGABE ERGÄNZEN>>|Titel des Berichts|Untertitel|Fünfte Ebene|Vorläufiger Text.|Fülltext für das Layout.|Musterabsatz.|Inhalt folgt noch.|Beispielblock ohne Inhalt.|Dieser Text dient als Platzhalter und wird bald ausgetauscht.|Tippen, um einen Titel hinzuzufügen|Doppelklicken zum Bearbeiten|Erste Ebene der Gliederung|Vierte Ebene|Titel der Folie|Name des Autors|Noch zu ergänzen.|NOCH OFFEN",
}
_FORMS = {
    "es": "Fecha: XX-XX-XX. Responsable: ____.|Lugar: ______|Elaboró: ________ Revisó: ________|Día: __/__/____. Firma: ________.|Nombre: ________ Cargo: ________|Hora: XX:XX. Sitio: XXXX.", "en": "Date: XX-XX-XX. Owner: ____.|Place: ______|Prepared by: ________ Checked by: ________|Day: __/__/____. Signed: ________.|Name: ________ Role: ________|Time: XX:XX. Site: XXXX.", "pt": "Data: XX-XX-XX. Responsável: ____.|Local: ______|Elaborou: ________ Revisou: ________|Dia: __/__/____. Assinatura: ________.|Nome: ________ Cargo: ________|Hora: XX:XX. Sítio: XXXX.",
    "fr": "Date : XX-XX-XX. Responsable : ____.|Lieu : ______|Rédigé par : ________ Relu par : ________|Jour : __/__/____. Signature : ________.|Nom : ________ Poste : ________|Heure : XX:XX. Site : XXXX.", "de": "Datum: XX-XX-XX. Zuständig: ____.|Ort: ______|Erstellt: ________ Geprüft: ________|Tag: __/__/____. Unterschrift: ________.|Name: ________ Amt: ________|Zeit: XX:XX. Stelle: XXXX.",
}
# The words of the usual Latin filler text.
_LATIN = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud "
    "exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
# slots: names, notations and what an empty slot is rendered as, in sentences that S stands for
_SLOT_NAMES = "apellido ciudad region indicador periodo valor_2 campo_3 cantidad surname city region indicator period value_2 count owner cidade periodo_2 orgao ville periode montant stadt zeitraum anzahl betrag id_caso doc_title user_name report_date".split()
_WRAPS = ["{%s}", "{{%s}}", "{{ %s }}", "{{{%s}}}", "${%s}", "#{%s}", "%%%s%%", "$%s$", "@@%s@@", "@%s@", "[%s]", "[[%s]]", "[%%%s%%]", "<%s>", "<<%s>>", "__%s__", "<%%= %s %%>", "<%% %s %%>", "&lt;%s&gt;", "«%s»", "{%% %s %%}", "~%s~", "(%%%s%%)", "%%(%s)s", "::%s::"]
_EMPTY = ["nan", "NaN", "null", "None", "undefined", "#N/A", "#REF!", "???", "N/D", "[object Object]"]
_SLOT_SENTENCES = [
    "Apreciada S: la zona S tuvo S reportes en S.", "Boletín sobre S, periodo S, redactado por S.", "Actualizado el S por S.", "La vereda S sumó S reportes al cierre de S, según S.", "Fuente: S. Total: S.",
    "Hello S, area S had S reports in S.", "Newsletter about S, period S, written by S.", "Updated on S by S.", "The village of S counted S reports at the close of S, says S.", "Source: S. Total: S.",
    "Cara S: a área S teve S registros em S.", "Boletim sobre S, período S, redigido por S.", "Atualizado em S por S.", "A aldeia S somou S registros até o fim de S.", "Bonjour S, la zone S a eu S relevés en S.",
    "Bulletin sur S, période S, écrit par S.", "Mis à jour le S par S.", "Le hameau S compte S relevés à la fin de S.", "Hallo S, im Gebiet S gab es S Meldungen im S.", "Mitteilung über S, Zeitraum S, verfasst von S.",
    "Aktualisiert am S von S.", "Das Dorf S zählte S Meldungen Ende S.", "S", "S S", "S, S",
]
#: Prose that tells of such things, and short lines that aren't residue.
TOLD = [
    "La plataforma devolvió un error 500 la noche del cierre, y el equipo volvió a cargar las actas al otro día.", "El taller enseña a habilitar JavaScript en computadores viejos y a cuidar las contraseñas.", "Al periodista le negaron el acceso al muelle durante tres días de 2011.",
    "La editora contó que el texto de relleno lorem ipsum viene de una obra antigua.", "La tabla agrupa los conjuntos {1, 2, 3} de boyas vecinas.", "La guía pide reemplazar «[cargo]» por el puesto de cada quien.", "La página 18 del acta cuenta el caso, y el enlace con la frontera quedó abierto.",
    "El servidor público firmó el contrato, y el documento pasó al archivo del municipio.", "El puente no estuvo disponible por la crecida y la carga esperó en la orilla.", "La sesión del concejo terminó tarde y el acta quedó pendiente.", "El mapa no incluye la vereda porque nadie la visitó.",
    "The site gave a 500 error on the closing night, and the team loaded the records again next day.", "The course shows how to enable JavaScript on old computers and why passwords matter.", "The reporter was denied access to the pier for three days in 2011.",
    "The editor said that the filler text lorem ipsum comes from an old book.", "The table groups the sets {1, 2, 3} of nearby buoys.", "The manual asks to replace “[role]” by the post of each one.", "Page 18 of the record tells the case, and the link with the border stayed open.",
    "The session of the council ended late and the record was left open.", "The map does not include the village because nobody went there.", "The bridge was not available during the flood and the load waited on the bank.",
    "A plataforma deu erro 500 na noite do encerramento, e a equipe refez a carga no outro dia.", "O curso ensina a habilitar o JavaScript em máquinas antigas.", "Negaram o acesso ao cais por três dias em 2011.", "A página 18 da ata conta o caso.", "A sessão da câmara terminou tarde e a ata ficou aberta.",
    "La plateforme a rendu une erreur 500 le soir de la clôture, et l’équipe a tout rechargé le lendemain.", "Le cours montre comment autoriser JavaScript sur de vieux ordinateurs.", "L’accès au quai a été refusé trois jours en 2011.", "La page 18 du registre raconte le cas.", "La séance du conseil a fini tard.",
    "Die Plattform meldete am Abend einen Fehler 500, das Team lud die Akten am nächsten Tag neu.", "Der Kurs zeigt, wie man JavaScript auf alten Rechnern einschaltet.", "Der Zugang zum Kai wurde 2011 drei Tage lang verweigert.", "Seite 18 der Akte schildert den Fall.", "Die Sitzung des Rates endete spät.",
    "Portada", "Contacto", "Mapa del sitio", "Noticias", "Contact", "News", "Site map", "Contato", "Notícias", "Actualités", "Kontakt", "Neuigkeiten", "[7]", "- 31 -", "p. 9", "INFORME DEL MES", "ZWEITER BERICHT", "Why not?!", "The board (says the minute) read it.",
    "x" * 90, "-" * 60, "ORIENTE BAJO", "SUR DEL RÍO", "EASTERN FILE", "DOSSIER SUD", "Under Art. 5 the board met.", "Resumen anual", "NOTA DE CAMPO", "Boletín del agua", "Field note", "Annual summary", "Resumo anual", "Note de terrain", "Jahresbericht", "o remo (12)", "o bote;", "– bomba (3);", "- brújula", "• cable", "El acta dice: «La junta revisó el plan.»",
]


def training(seed: int = 7) -> list[list[str]]:
    """Three classes of residue: notices (errors, access, scripts), filler and instructions, slots."""
    rng = random.Random(seed)
    notices: list[str] = []
    for k in _THINGS:
        grid = [f"{a} {b}" for a in _THINGS[k].split("|") for b in _FAILS[k].split("|")]
        notices += rng.sample(grid, 300) + _NOTICES[k].split("|") * 6
        notices += [" ".join(x) for x in itertools.product(*(p.split("|") for p in _SCRIPTS[k]))] + _SCRIPT_NOTICES[k].split("|") * 12
    filler: list[str] = []
    for k in _DO:
        for a, b, c in itertools.product(*(p.split("|") for p in _DO[k])):
            s = f"{a} {b} {c}"
            filler.append(rng.choice([s, f"{s}.", f"[{s}]", f"({s.lower()})", f"<<{s.upper()}>>", f"{{{s}}}"]))
        filler += (_FILLER[k].split("|") + _FORMS[k].split("|")) * 12
    for _ in range(500):
        filler.append((" ".join(rng.choices(_LATIN, k=rng.randint(4, 14))) + ".").capitalize())
    slots = []
    for _ in range(2500):
        wrap, name = rng.choice(_WRAPS + _EMPTY), rng.choice(_SLOT_NAMES)
        name = name.upper() if rng.random() < 0.3 else name
        fill = wrap % name if "%s" in wrap else wrap
        slots.append(re.sub(r"\bS\b", lambda _: fill, rng.choice(_SLOT_SENTENCES)))
    return [notices + [x.upper() for x in rng.sample(notices, 300)], filler, slots]
