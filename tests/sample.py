"""Thirty detections of a sky survey: right ascension, declination, object id.

Fixed values: they are the input of a worked example whose cells, counts and merged groups
are known, so the expected results in the tests hold for these points and no others.
"""

SAMPLE = [
    (358.08941191498536, 3.039583881799817, None),
    (358.08276596738045, 3.066563961238612, None),
    (358.0817920705075, 3.0704886608229702, None),
    (358.0690268498278, 3.123310045440112, None),
    (358.0785942563585, 3.0226372477567103, None),
    (358.06655508758325, 3.068457000337906, None),
    (358.0477711271595, 3.1382841723274337, None),
    (358.0382162238455, 3.174559184645623, None),
    (358.076881847349, 3.0208853129451105, None),
    (358.0670506869748, 3.0574251840312736, None),
    (5.12087444172781, 2.559653764516827, None),
    (5.117220258576432, 2.55342053350002, 430261233778748),
    (5.151657343054651, 2.606349111473969, None),
    (5.185121747062516, 2.6586210329627056, None),
    (5.113437904742045, 2.546057851547172, None),
    (5.10679028997275, 2.5352212173711206, 430261233778737),
    (5.155584071702516, 2.6091711324029365, None),
    (5.159990470736904, 2.615923773425997, 430261233778866),
    (5.15896402759509, 2.6142417655417214, None),
    (5.115305432579376, 2.545739441784833, 430261233778741),
    (4.569694680844982, 3.216566937539352, 433349315265614),
    (4.657504305332596, 3.2182104890953838, 433349315265919),
    (4.499847385288585, 3.2154401866851443, 433349315264725),
    (4.672369877021147, 3.218598407411144, 433349315268474),
    (4.563114115461182, 3.216912580630067, 433349315265603),
    (4.5521517384995995, 3.2171446208834813, 433349315265594),
    (4.6808252298870014, 3.2195922508790047, 433349315268484),
    (4.480710594753096, 3.216466019310668, 433349315264710),
    (4.569341931205432, 3.217855540644897, 433349315265612),
    (4.661187549586043, 3.2193966303566968, 433349315265926),
]
