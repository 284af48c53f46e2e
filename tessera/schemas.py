"""Schemas of the logical tables of the comment pipeline."""

from pyspark.sql import types as T

_S, _L, _D, _B, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


COMMENTS_RAW = _table(_id=_S, Commentaire_Client=_S, commentaire_moderateur=_S, date=_S, source=_S, moderateur=_S, traite=_B, statut=_S, metadata=_table(fichier=_S, ligne=T.IntegerType(), date_import=_TS))
COMMENT_MESSAGE = _table(commentaire=_S, source=_S, mongo_id=_S, timestamp=_S)
COMMENTS_NORMALIZED = _table(_id=_S, Commentaire_Client=_S, Commentaire_Client_Original=_S, normalized_arabert=_S, normalized_full=_S, emojis_originaux=T.ArrayType(_S), emojis_sentiment=T.ArrayType(_S), labeled=_S, labeled_date=_TS, pending_date=_TS, score=_D, confidence=_D, reason=_S, label=_S)
COMMENTS_LABELED = _table(mongo_id=_S, normalized_arabert=_S, label=_S, score=_D, confidence=_D, reason=_S, labeled=_B, labeled_date=_TS, import_batch=_S)
DATASET_UNIFIED = _table(_id=_S, Group_ID=_S, nb_occurrences=_L, normalized_arabert=_S, score=_D, confidence=_D, label_final=_S, conflit=_B, dates=T.ArrayType(_S), sources=T.ArrayType(_S), moderateurs=T.ArrayType(_S), labels_originaux=T.ArrayType(_S))
PREDICTIONS = _table(commentaire_original=_S, texte_normalise=_S, hash_texte=_S, source=_S, label=_S, confidence=_D, probabilities=T.MapType(_S, _D), frequence=_L, date_creation=_TS, derniere_occurrence=_TS)
CONVERSATIONS = _table(session_id=_S, user_name=_S, message=_S, texte_normalise=_S, langue_detectee=_S, intention=_S, confiance=_D, top3=T.ArrayType(_table(intention=_S, score=_D)), reponse=_S, timestamp=_TS)
