"""Problem 2 on notices, filler and prose that the models have never seen: at least 0.9 of both recall and precision."""

import numpy as np

from riverloom.llm import ngrams, residue, residue_text

UNSEEN = """La página a la que intenta entrar no está publicada.|Error 410: este contenido fue eliminado de manera permanente.|No se pudo establecer conexión con el servidor.|Usted no tiene autorización para consultar este archivo.|Su cuenta fue bloqueada por intentos fallidos.|Espere unos segundos y recargue la página.|Este enlace ya no funciona.|Vuelva a iniciar sesión para ver el documento.|El sitio se encuentra en mantenimiento.|Demuestre que no es un robot.
JavaScript está desactivado en este navegador.|Active JavaScript y vuelva a cargar el sitio.|Para ver esta página habilite los scripts.|Haga clic para añadir texto aquí|Escriba un título para este documento|Texto de ejemplo para reemplazar.|[Insertar nombre del autor]|Lorem ipsum dolor sit amet, sed do eiusmod.|Contenido pendiente.|El documento solicitado no se encuentra disponible.
The page you are trying to open is not published.|Error 410: this content was removed for good.|Could not connect to the server.|You are not authorized to view this file.|Your account was locked after failed attempts.|Wait a few seconds and reload the page.|This link no longer works.|Sign in again to view the document.|The site is under maintenance.|Prove that you are not a robot.
JavaScript is turned off in this browser.|Enable JavaScript and reload the site.|To view this page please allow scripts.|Click here to add your text|Type a title for this document|Sample text to be replaced.|[Insert name of the author]|Lorem ipsum dolor sit amet, ut labore et dolore.|Content to be added.|The requested document is not available.
A página que você tenta abrir não está publicada.|Erro 410: este conteúdo foi removido para sempre.|Não foi possível conectar ao servidor.|Você não tem autorização para ver este arquivo.|Sua conta foi bloqueada por tentativas.|Espere alguns segundos e recarregue a página.|Este link não funciona mais.|Entre novamente para ver o documento.|O site está em manutenção.|Prove que você não é um robô.
O JavaScript está desligado neste navegador.|Ative o JavaScript e recarregue o site.|Para ver esta página, permita os scripts.|Clique aqui para adicionar seu texto|Digite um título para este documento|Texto de exemplo a substituir.|[Inserir nome do autor]|Lorem ipsum dolor sit amet, quis nostrud.|Conteúdo pendente.|O documento solicitado não está disponível.
La page que vous essayez d’ouvrir n’est pas publiée.|Erreur 410 : ce contenu a été supprimé.|Impossible de se connecter au serveur.|Vous n’êtes pas autorisé à voir ce fichier.|Votre compte a été bloqué après des tentatives.|Patientez quelques secondes et rechargez la page.|Ce lien ne fonctionne plus.|Connectez-vous de nouveau pour voir le document.|Le site est en maintenance.|Prouvez que vous n’êtes pas un robot.
JavaScript est désactivé dans ce navigateur.|Activez JavaScript et rechargez le site.|Pour voir cette page, autorisez les scripts.|Cliquez ici pour ajouter votre texte|Saisissez un titre pour ce document|Texte d’exemple à remplacer.|[Insérer le nom de l’auteur]|Lorem ipsum dolor sit amet, ex ea commodo.|Contenu à venir ici.|Le document demandé n’est pas disponible.
Die Seite, die Sie öffnen möchten, ist nicht veröffentlicht.|Fehler 410: dieser Inhalt wurde dauerhaft gelöscht.|Es konnte keine Verbindung zum Server hergestellt werden.|Sie sind nicht berechtigt, diese Datei zu sehen.|Ihr Konto wurde nach Fehlversuchen gesperrt.|Warten Sie einige Sekunden und laden Sie die Seite neu.|Dieser Link funktioniert nicht mehr.|Melden Sie sich wieder an, um das Dokument zu sehen.|Die Website wird gerade gewartet.|Beweisen Sie, dass Sie kein Roboter sind.
JavaScript ist in diesem Browser ausgeschaltet.|Aktivieren Sie JavaScript und laden Sie die Website neu.|Um diese Seite zu sehen, erlauben Sie Skripte.|Klicken Sie hier, um Ihren Text hinzuzufügen|Geben Sie einen Titel für dieses Dokument ein|Beispieltext, bitte ersetzen.|[Namen des Autors einfügen]|Lorem ipsum dolor sit amet, duis aute irure.|Inhalt folgt.|Das angeforderte Dokument ist nicht verfügbar."""
SOUND = """La empresa cerró la planta y despidió a cien obreros.|El alcalde prometió reparar la carretera antes de mayo.|Los pescadores cuentan que el río bajó dos metros.|El informe compara los precios de tres mercados.|Una patrulla encontró dos motores bajo el puente.|La escuela perdió el techo con la tormenta.|El juez pidió más pruebas al fiscal.|La cosecha de cacao creció el año pasado.|Nadie vio salir la lancha del muelle.|Las lluvias cortaron el paso hacia la sierra.
El servidor de la alcaldía llegó tarde a la audiencia.|La página del libro estaba rota.|El documento más viejo del archivo es de 1820.|Ese enlace ferroviario une dos puertos.|El permiso de pesca vence en junio.|La sesión del congreso duró nueve horas.|El técnico activó la alarma de la presa.|El mapa muestra las minas de la zona.|El texto de la ley cambió en 2004.|La dirección del hospital renunció.
The firm closed the plant and laid off a hundred workers.|The mayor promised to mend the road before May.|Fishermen say the river fell by two metres.|The report compares prices in three markets.|A patrol found two engines under the bridge.|The school lost its roof in the storm.|The judge asked for more evidence.|The cocoa harvest grew last year.|Nobody saw the boat leave the pier.|Rain cut the road to the hills.
The page of the book was torn.|The oldest document in the archive is from 1820.|That rail link joins two ports.|The fishing licence ends in June.|The session of congress lasted nine hours.|The engineer set off the alarm of the dam.|The map shows the mines of the area.|The text of the law changed in 2004.|A server at the bar saw the accident.|Access to clean water improved.
A empresa fechou a fábrica e demitiu cem operários.|O prefeito prometeu consertar a estrada.|Os pescadores dizem que o rio baixou dois metros.|O relatório compara os preços de três mercados.|Uma patrulha achou dois motores sob a ponte.|A escola perdeu o telhado na tempestade.|O juiz pediu mais provas.|A safra de cacau cresceu no ano passado.|Ninguém viu o barco sair do cais.|A chuva cortou o caminho da serra.
A página do livro estava rasgada.|O documento mais velho do arquivo é de 1820.|Essa ligação férrea une dois portos.|A licença de pesca vence em junho.|A sessão do congresso durou nove horas.|O técnico acionou o alarme da represa.|O mapa mostra as minas da região.|O texto da lei mudou em 2004.|O acesso à água melhorou.|A direção do hospital renunciou.
L’entreprise a fermé l’usine et licencié cent ouvriers.|Le maire a promis de réparer la route.|Les pêcheurs disent que le fleuve a baissé de deux mètres.|Le rapport compare les prix de trois marchés.|Une patrouille a trouvé deux moteurs sous le pont.|L’école a perdu son toit dans la tempête.|Le juge a demandé plus de preuves.|La récolte de cacao a augmenté l’an dernier.|Personne n’a vu le bateau partir du quai.|La pluie a coupé la route des collines.
La page du livre était déchirée.|Le plus vieux document des archives date de 1820.|Cette liaison ferrée unit deux ports.|Le permis de pêche finit en juin.|La séance du congrès a duré neuf heures.|Le technicien a déclenché l’alarme du barrage.|La carte montre les mines de la région.|Le texte de la loi a changé en 2004.|L’accès à l’eau s’est amélioré.|La direction de l’hôpital a démissionné.
Die Firma schloss das Werk und entließ hundert Arbeiter.|Der Bürgermeister versprach, die Straße zu reparieren.|Die Fischer sagen, der Fluss sei um zwei Meter gefallen.|Der Bericht vergleicht die Preise von drei Märkten.|Eine Streife fand zwei Motoren unter der Brücke.|Die Schule verlor im Sturm ihr Dach.|Der Richter verlangte mehr Beweise.|Die Kakaoernte wuchs im letzten Jahr.|Niemand sah das Boot vom Kai ablegen.|Der Regen schnitt den Weg in die Berge ab.
Die Seite des Buches war zerrissen.|Das älteste Dokument im Archiv stammt von 1820.|Diese Bahnlinie verbindet zwei Häfen.|Der Fischereischein endet im Juni.|Die Sitzung des Kongresses dauerte neun Stunden.|Der Techniker löste den Alarm am Damm aus.|Die Karte zeigt die Minen der Gegend.|Der Text des Gesetzes änderte sich 2004.|Der Zugang zu Wasser wurde besser.|Die Leitung des Spitals trat zurück."""


def _split(s):
    return [x for line in s.split("\n") for x in line.split("|")]


def test_unseen_residue():
    bad, good = _split(UNSEEN), _split(SOUND)
    known = {s for c in residue_text.training() for s in c}
    assert len(bad) == len(good) == 100 and not known & set(bad)
    seen, held = good[::2], good[1::2]
    model = residue.ResidueModel([" ".join(seen[i : i + 2]) for i in range(0, 50, 2)] * 20)
    hit, wrong = sum(model.flags(bad)), sum(model.flags(held))
    assert hit >= 90 and hit / (hit + 2 * wrong) >= 0.9


def test_windows_are_localised(spark):
    text = "La escuela perdió el techo. El sitio se encuentra en mantenimiento. Nadie vio salir la lancha."
    more = [(f"k{i}", x) for i, x in enumerate(_split(SOUND)) if "techo" not in x and "lancha" not in x]
    df = spark.createDataFrame([*more, ("a", text), ("a", text), ("b", "Nadie vio salir la lancha."), ("n", None), ("e", " ")], "chunk_id string, texto string")
    w = residue.residue_windows(df).where("chunk_id in ('a', 'b', 'n', 'e')").collect()
    assert [(r.chunk_id, text[r.inicio : r.fin].strip(), r.clase) for r in w] == [("a", "El sitio se encuentra en mantenimiento.", "aviso")]
    assert {"b", "e", "n"} <= (kept := {r.chunk_id for r in residue.keep(df).collect()}) and "a" not in kept and residue.keep(df, 0.9).where("chunk_id = 'a'").count() == 2
    assert residue.residue_windows(df.limit(0)).count() == 0


def test_fit_counts_every_fragment(spark):
    """No sample: the distributed fit equals the fit on all texts at once, however the table is cut, also beyond the size that weights are set for."""
    texts = [f"{a} {b} {i % 7}" for i, (a, b) in enumerate(zip(_split(SOUND) * 65, _split(SOUND)[7:] * 70))]
    texts += ["La ficha quedó sin abrirse, toque otra vez el recuadro. Elija otro visor."] * 40
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)] + [("n", None)], "chunk_id string, texto string")
    whole = [t.view(np.float32) for t in residue.ResidueModel(texts).tables]
    for rows in (df.repartition(3), df.repartition(7, "texto")):
        fitted = [t.view(np.float32) for t in residue.fit_residue(rows).tables]
        assert len(texts) > 6000 and all(np.array_equal(a, b) for a, b in zip(fitted, whole))


def test_windows_hang_on_their_own_text_alone():
    texts = ["null", "El sitio se encuentra en mantenimiento.", "", "La escuela perdió el techo."]
    model = residue.ResidueModel(_split(SOUND))
    together, alone = model.windows(texts), [model.windows([t]) for t in texts]
    assert together.ratio.tolist() == [x for w in alone for x in w.ratio.tolist()]


def test_lower_case_is_that_of_the_text():
    """Also where it is longer than the character or hangs on those around it."""
    every = [chr(c) for c in range(0x20000)]
    for texts in (every, [c for c in every if c not in "İΣ"], ["ΟΔΟΣ", "ΣΑΣ 12"], ["İzmir 2ª"], [""], []):
        want = [48 if "0" <= c <= "9" else ord(c) for c in "".join(ngrams._lower(t) + ngrams.END for t in texts)]
        assert ngrams.Batch(texts).codes.tolist() == want


def test_every_notation_holds_a_mark():
    for piece in ("nan", "NaN", "NAN", "null", "NULL", "None", "NONE", "undefined", "UNDEFINED", "N/D", "#N/A", "???", "{{ a }}", "[nombre]", "%nombre%", "$autor$", "@@ a @@", "&lt;a&gt;", "__a__", "::a::", "~a_b~"):
        assert residue._RENDERED.search(piece) or residue._SLOT.search(piece)
        assert residue._MARK.search(piece) or any(map(piece.__contains__, residue._MARK_WORDS))
